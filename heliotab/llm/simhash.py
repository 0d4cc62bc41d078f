"""SimHash near-duplicates by tiled exact comparison of fingerprints.

Fingerprints are compared by exclusive-or and bit counts on NumPy tiles. Two fingerprints within the
radius have block population counts (bits set in each quarter) whose differences sum to at most the
radius, so a tile only meets the tiles of near population counts; all others are skipped.

Defined results: a null or blank text has fingerprint 0 and links like any other; repeated rows and
equal doc_ids each give a row; a null doc_id gives a row but is never a component's id unless the
component has no other; an empty table gives no rows; columns other than id and text are not read.
"""

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .components import components
from .registry import query, table
from .textbytes import LOWER_TABLE, text_bytes, word_blocks

SEED = 42
SHINGLE = 3
RADIUS = 2
BLOCKS = 4
TILE = 20_000  # fingerprints on a side of a tile pair
HELD = 1 << 18  # links of a group kept before they are reduced to a forest


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over the XXH64 of all word shingles, repeats included; 0 without words."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for words in word_blocks(text.translate(LOWER_TABLE)):
        words = tail + words
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1]
            spans = zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist())
            hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = words[-(shingle - 1) :] if shingle > 1 else []
    if not total:
        if not tail:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp): a fingerprint per row; th is a hash of the text that tells equal ids apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(2))
            fps = [fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(at[:-1], at[1:])]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(signed)], names=["doc_id", "th", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, th long, fp long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace links by as few that connect the same vertices: each vertex with the least it reaches."""
    names, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]


def near(homes: np.ndarray, visitors: np.ndarray, radius: int, rows: int = 256, columns: int = 2048):
    """Index pairs of fingerprints within the radius, from sub-tiles sorted by population count."""
    home_order, visit_order = np.argsort(np.bitwise_count(homes), kind="stable"), np.argsort(np.bitwise_count(visitors), kind="stable")
    hs, vs = homes[home_order], visitors[visit_order]
    hp, vp = np.bitwise_count(hs).astype(np.int64), np.bitwise_count(vs).astype(np.int64)
    for i in range(0, len(hs), rows):
        first = np.searchsorted(vp, hp[i] - radius, "left")
        last = np.searchsorted(vp, hp[min(i + rows, len(hs)) - 1] + radius, "right")
        for j in range(first, last, columns):
            tile = np.bitwise_count(hs[i : i + rows, None] ^ vs[None, j : min(j + columns, last)])
            x, y = np.nonzero(tile <= radius)
            if len(x):
                yield home_order[i + x], visit_order[j + y]


def neighbour_offsets(blocks: int, radius: int) -> list[list[int]]:
    """Differences of block population counts within the radius, one of each opposite pair."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=blocks) if sum(map(abs, s)) <= radius]
    return [list(s) for s in steps if next((x for x in s if x), 1) > 0]


def links(points: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(a, b) links that connect all distinct fingerprints (column fp) at most ``radius`` bits apart.

    Tiles are keyed by block population counts. The tile counts, at most (64/blocks + 1)**blocks
    rows, are broadcast; a key with more fingerprints than a tile is split on both sides, so each
    task group holds two tiles however many fingerprints share a key. A group returns a spanning
    forest of its links, not the pairs.
    """
    width, base = 64 // blocks, 64 // blocks + 1
    pops = F.array(*[F.bit_count(F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << width) - 1))) for i in range(blocks)])
    offsets = F.array(*[F.array(*map(F.lit, o)) for o in neighbour_offsets(blocks, radius)])

    def key(counts):
        out = F.lit(0)
        for i in range(blocks):
            out = out * base + counts[i]
        return out.cast("int")

    points = points.select("fp", pops.alias("pops"))
    home = points.select("fp", key(F.col("pops")).alias("key"))
    visits = (
        points.withColumn("step", F.explode(offsets))
        .withColumn("there", F.zip_with("pops", "step", lambda p, s: p + s))
        .filter(F.forall("there", lambda c: (c >= 0) & (c <= width)))
        .select("fp", key(F.col("there")).alias("key"))
    )
    sizes = settle(
        points.groupBy("pops").count()
        .withColumn("step", F.explode(offsets))
        .withColumn("there", F.zip_with("pops", "step", lambda p, s: p + s))
        .filter(F.forall("there", lambda c: (c >= 0) & (c <= width)))
        .withColumn("own", F.when(F.forall("step", lambda s: s == 0), F.col("count")).otherwise(0))
        .groupBy(key(F.col("there")).alias("key"))
        .agg(F.sum("own").alias("own"), F.sum("count").alias("guests"))
        .filter("own > 0")
        .select("key", F.ceil(F.col("own") / tile).cast("int").alias("tiles"), F.ceil(F.col("guests") / tile).cast("int").alias("parts")),
        "tiles",
    )
    here = home.join(F.broadcast(sizes), "key").select(
        "key", F.pmod(F.xxhash64("fp"), "tiles").cast("int").alias("h"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("v"), F.lit(True).alias("home"), "fp",
    )
    there = visits.join(F.broadcast(sizes), "key").select(
        "key", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("h"),
        F.pmod(F.xxhash64("fp", F.lit(1)), "parts").cast("int").alias("v"), F.lit(False).alias("home"), "fp",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(group) -> pa.RecordBatch | None:
            is_home, fp = (np.concatenate(x) for x in zip(*group))
            homes, visitors = fp[is_home], fp[~is_home]
            a, b, held = [], [], 0
            for i, j in near(homes.view(np.uint64), visitors.view(np.uint64), radius):
                a.append(homes[i])
                b.append(visitors[j])
                held += len(i)
                if held > HELD:
                    x, y = forest(np.concatenate(a), np.concatenate(b))
                    a, b, held = [x], [y], len(x)
            if not a:
                return None
            x, y = forest(np.concatenate(a), np.concatenate(b))
            return pa.record_batch([pa.array(x), pa.array(y)], names=["a", "b"])

        group, at = [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            is_home, fp = batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).to_numpy()
            for s, e in zip([0, *cuts], [*cuts, batch.num_rows]):
                if at != tuple(keys[:, s]):
                    if group and (out := done(group)) is not None:
                        yield out
                    group, at = [], tuple(keys[:, s])
                group.append((is_home[s:e], fp[s:e]))
        if group and (out := done(group)) is not None:
            yield out

    return (
        here.union(there)
        .repartition("key", "h", "v")
        .sortWithinPartitions("key", "h", "v")
        .mapInArrow(compare, "a long, b long")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, th, fp, component_id): the least doc_id reachable over links, for every row."""
    rows = settle(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    points = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    labels = components(links(points, radius))
    linked = points.join(labels, points.fp == labels.vertex)
    least = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    of_linked = linked.join(least, "label").select("fp", "component_id")
    found = points.join(of_linked.withColumnRenamed("fp", "p"), F.col("fp") == F.col("p"), "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")
    )
    return rows.join(found, "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of the least id stays.

    Rows equal in id and text are told apart by number, so exactly one row of a component is kept.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    # Least id first, nulls last; ties by text.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "th")
    stays = found.groupBy(F.col("component_id").isNull(), F.when(F.col("component_id").isNull(), F.col("fp")).otherwise(F.lit(0)), "component_id").agg(F.min(order).alias("k"))
    stays = stays.select(F.col("k.doc_id").alias("__kept_id"), F.col("k.th").alias("__kept_th"))
    names = docs.columns
    marked = docs.withColumn("__kept_h", F.xxhash64(text_col)).join(
        stays, F.col(id_col).eqNullSafe(F.col("__kept_id")) & (F.col("__kept_h") == F.col("__kept_th"))
    )
    one = Window.partitionBy(id_col, "__kept_h").orderBy("__kept_th")
    return marked.withColumn("__kept_n", F.row_number().over(one)).filter("__kept_n = 1").select(*[F.col(f"`{n}`") for n in names])


@query("op4_simhash_near_dedup")
def op4(spark, sf_dir):
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
