"""Near-duplicate vectors by spherical-cap filters with list-decodable product codes.

A filter is a direction; a vector passes it when their cosine is at least ``cap_height``. Directions
are products: in each of ``ROTATIONS`` random rotations the space is cut into ``BLOCKS`` blocks, each block
has its own random codewords, and a direction takes one codeword per block. All directions that a
vector exceeds are therefore listed block by block, with those abandoned that the remaining blocks
cannot lift above the cap, instead of one by one. Vectors meet where they share a filter, and every
pair that meets is verified with its cosine in double precision.

For a pair of a given cosine the chance of sharing a filter does not depend on the data, since the
rotations are random. The cap height is set so that at most ``MISS`` of the pairs exactly at the
threshold share none (simulated by ``cap_height``); closer pairs are missed less. The number of codewords
grows with the largest class, so that a filter holds about ``FILTER_ROWS`` of its vectors.

Vectors are compared within a class (equal, non-null label and equal length). A class is cut into parts
by a hash of the filter once every vector would otherwise meet more tiles than it has filters; a part is cut
into tiles of ``TILE`` vectors, and a task group holds two tiles, however many vectors share a filter. A
group reports numbers of links and one tree per connected set, never the pairs. A pair counts in the
part of its least common part alone. Equal vectors are one point with a weight.

Defined results: a row whose vector is null, empty, zero or holds a null or non-finite component, or
whose label is null, has no links; vectors of different lengths do not link; repeated rows are
vectors of their own that link with each other (cosine 1); a null id never is a component's least id
unless all its ids are null; ``kept`` compares null-safely, so an unlinked row without an id is kept; an empty
table gives no rows; columns of other names are not read.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .components import components
from .registry import query, table

COSINE = 0.93
MISS = 0.001  # of the pairs exactly at the threshold
ROTATIONS = 8
BLOCKS = 2
LEAST_WORDS, MOST_WORDS = 16, 256  # codewords of a block
FILTER_ROWS = 1_000
TILE = 4_096
SHARED = 36  # filters of a vector, about
SLAB = 256
SIMULATED = 8_000
SEED = 11


@lru_cache(8)
def codes(dim: int, words: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Per rotation: its matrix and the codewords of each block (scaled so that a product has length 1)."""
    rng = np.random.default_rng([SEED, dim, words])
    blocks = min(BLOCKS, dim)
    widths = [len(part) for part in np.array_split(np.arange(dim), blocks)]
    out = []
    for _ in range(ROTATIONS):
        rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        made = [rng.normal(size=(words, w)) for w in widths]
        # In one dimension there are two directions only.
        made = [np.unique(c / np.linalg.norm(c, axis=1, keepdims=True), axis=0) / np.sqrt(blocks) for c in made]
        out.append((rotation, made))
    return out


def block_scores(unit: np.ndarray, rotation: np.ndarray, words: list[np.ndarray]) -> list[np.ndarray]:
    """For every block the products of all vectors with all codewords."""
    turned, out, at = unit @ rotation, [], 0
    for c in words:
        out.append(turned[:, at : at + c.shape[1]] @ c.T)
        at += c.shape[1]
    return out


@lru_cache(8)
def cap_height(dim: int, words: int, cosine: float, miss: float) -> float:
    """The greatest height at which all but ``miss`` of random pairs of that cosine share a filter."""
    rng = np.random.default_rng([SEED, dim, words, 1])
    x = rng.normal(size=(SIMULATED, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if dim == 1:
        return 0.5
    z = rng.normal(size=(SIMULATED, dim))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * z
    best = np.full(SIMULATED, -1.0)
    for rotation, made in codes(dim, words):
        for at in range(0, SIMULATED, 50):
            part = slice(at, at + 50)
            both = []
            for side in (x[part], y[part]):
                total = np.zeros((len(side), 1))
                for s in block_scores(side, rotation, made):
                    total = (total[:, :, None] + s[:, None, :]).reshape(len(side), -1)
                both.append(total)
            best[part] = np.maximum(best[part], np.minimum(*both).max(axis=1))
    return float(np.quantile(best, miss, method="lower"))


def list_decode(unit: np.ndarray, words: int, height: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of every direction that a row exceeds, ordered by row and filter."""
    rows, filters, base = [], [], 0
    for rotation, made in codes(unit.shape[1], words):
        scores = block_scores(unit, rotation, made)
        row, name, sums = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
        rest = [s.max(axis=1) for s in scores]
        for i, s in enumerate(scores):
            above = sum(rest[i + 1 :], np.zeros(len(unit)))
            nexts = []
            for at in range(0, len(row), 1 << 14):
                r, partial = row[at : at + (1 << 14)], sums[at : at + (1 << 14)]
                total = partial[:, None] + s[r]
                x, word = np.nonzero(total + above[r, None] >= height)
                nexts.append((r[x], name[at + x] * s.shape[1] + word, total[x, word]))
            row, name, sums = (np.concatenate(x) for x in zip(*nexts)) if nexts else (row, name, sums)
        rows.append(row)
        filters.append(name + base)
        base += int(np.prod([len(c) for c in made]))
    row, name = np.concatenate(rows), np.concatenate(filters)
    order = np.lexsort((name, row))
    return row[order], name[order].astype(np.int32)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, in double precision."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    """A column of equally long packed vectors as unit rows."""
    return unit_rows(np.stack([np.frombuffer(v, kind) for v in column.to_pylist()]))


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0)


def codewords(largest: int) -> int:
    """Codewords of a block for a class of that many vectors: a filter's share falls by about their number ** 1.8."""
    wanted = LEAST_WORDS * (largest / (100 * FILTER_ROWS)) ** (1 / 1.8) if largest else 0
    return int(min(MOST_WORDS, max(LEAST_WORDS, 2 ** np.ceil(np.log2(max(1.0, wanted))))))


def part_of(filters: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The part that each filter belongs to, of as many as its class has."""
    mixed = filters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % parts.astype(np.uint64)).astype(np.int64)


class Side:
    """One tile of a part: vectors, weights and filters."""

    def __init__(self, num, weight, vectors, filters: pa.ListArray, part: int, parts: int):
        self.num, self.weight, self.x = num, weight, vectors
        names = filters.flatten().to_numpy()
        rows = filters.value_parent_indices().to_numpy()
        of = part_of(names, np.array(parts))
        here, before = of == part, of < part
        order = np.argsort(names[here], kind="stable")
        self.names, self.rows = names[here][order], rows[here][order]
        self.earlier = names[before], rows[before]


def members(side: Side, common: np.ndarray) -> list[np.ndarray]:
    """Rows that hold each of the common filters."""
    lo, hi = np.searchsorted(side.names, common, "left"), np.searchsorted(side.names, common, "right")
    return [side.rows[a:b] for a, b in zip(lo, hi)]


def linked_pairs(home: Side, visitor: Side, cosine: float) -> np.ndarray:
    """Matrix of the pairs that share a filter of this part and reach the cosine."""
    linked = np.zeros((len(home.num), len(visitor.num)), bool)
    common = np.intersect1d(home.names, visitor.names)
    for h, v in zip(members(home, common), members(visitor, common)):
        for at in range(0, len(h), SLAB):
            some = h[at : at + SLAB]
            known = linked[some[:, None], v]
            if not known.all():
                linked[some[:, None], v] = known | (home.x[some] @ visitor.x[v].T >= cosine)
    return linked


def drop_counted(linked: np.ndarray, home: Side, visitor: Side) -> None:
    """Clear the pairs that an earlier part has: those that share a filter of an earlier part."""
    common = np.intersect1d(home.earlier[0], visitor.earlier[0])
    if not len(common):
        return
    bits = []
    for side in (home, visitor):
        names, rows = side.earlier
        at = np.searchsorted(common, names)
        at[at == len(common)] = 0
        good = common[at] == names
        table = np.zeros((len(side.num), -(-len(common) // 64)), np.uint64)
        np.bitwise_or.at(table, (rows[good], at[good] // 64), np.uint64(1) << (at[good] % 64).astype(np.uint64))
        bits.append(table)
    for at in range(0, len(home.num), SLAB):
        i, j = np.nonzero(linked[at : at + SLAB])
        for s in range(0, len(i), 1 << 16):
            a, b = i[s : s + (1 << 16)] + at, j[s : s + (1 << 16)]
            shared = np.zeros(len(a), bool)
            for w in range(bits[0].shape[1]):
                shared |= (bits[0][a, w] & bits[1][b, w]) != 0
            linked[a[shared], b[shared]] = False


def trees(linked: np.ndarray, offset: int, size: int) -> np.ndarray:
    """The least member of each vertex's connected set; visitors are vertices from ``offset`` on."""
    root = np.arange(size)
    for at in range(0, len(linked), SLAB):
        i, j = np.nonzero(linked[at : at + SLAB])
        i, j = i + at, j + offset
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(root, root[root]):
                root = root[root]
    return root


def compare(home: Side, visitor: Side | None, cosine: float) -> pa.RecordBatch | None:
    """(a, b, n): links of each vector within this group, and a vector that it is connected with."""
    same = visitor is None
    visitor = home if same else visitor
    linked = linked_pairs(home, visitor, cosine)
    if same:
        np.fill_diagonal(linked, False)
    if not linked.any():
        return None
    root = trees(linked, 0 if same else len(home.num), len(home.num) + (0 if same else len(visitor.num)))
    drop_counted(linked, home, visitor)
    num = home.num if same else np.concatenate((home.num, visitor.num))
    count = np.zeros(len(num), np.int64)
    for at in range(0, len(home.num), SLAB):
        part = linked[at : at + SLAB]
        count[at : at + len(part)] += np.rint(part @ visitor.weight.astype(np.float64)).astype(np.int64)
        if not same:
            count[len(home.num) :] += np.rint(home.weight[at : at + len(part)].astype(np.float64) @ part).astype(np.int64)
    some = np.flatnonzero((count > 0) | (root != np.arange(len(num))))
    return pa.record_batch([pa.array(num[some]), pa.array(num[root[some]]), pa.array(count[some])], names=["a", "b", "n"])


GROUP = ["label", "d", "part", "lo", "hi"]


def meet(rows: DataFrame, kind: str, cosine: float) -> DataFrame:
    """(a, b, n) of all groups of two tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lo, hi, part, parts = (t.column(n)[0].as_py() for n in ("lo", "hi", "part", "parts"))
            own = t.column("own").to_numpy()

            def side(tile):
                some = t.filter(pa.array(own == tile))
                return some.num_rows and Side(
                    some.column("num").to_numpy(), some.column("weight").to_numpy(), matrix(some.column("vec"), kind),
                    some.column("filters"), part, parts,
                )

            home, visitor = side(lo), None if lo == hi else side(hi)
            return compare(home, visitor, cosine) if home and (lo == hi or visitor) else None

        held, at = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.zeros(batch.num_rows, bool)
            for name in GROUP:
                named = batch.column(name).dictionary_encode().indices.to_numpy()
                starts[1:] |= named[1:] != named[:-1]
            cuts = np.flatnonzero(starts).tolist()
            for s, e in zip([0, *cuts], [*cuts, batch.num_rows]):
                key = tuple(batch.column(n)[s].as_py() for n in GROUP)
                if key != at:
                    if held and (out := done(held)) is not None:
                        yield out
                    held, at = [], key
                held.append(batch.slice(s, e - s))
        if held and (out := done(held)) is not None:
            yield out

    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(run, "a long, b long, n long")


def near_duplicates(
    df: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
    miss: float = MISS, tile: int = TILE, words: int | None = None, shared: int = SHARED,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``df``."""
    double = df.schema[vec_col].dataType.elementType == T.DoubleType()
    kind, vec = ("<f8" if double else "<f4"), F.col(f"`{vec_col}`").cast("array<double>" if double else "array<float>")
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), vec.alias("vec"))
    rows = rows.withColumn("ok", F.coalesce(F.col("label").isNotNull() & usable(F.col("vec")), F.lit(False)))
    # A point: equal vectors of one label, named by 128 bits of hash.
    names = {"k1": F.xxhash64("label", "vec"), "k2": F.xxhash64(F.reverse("vec"), F.col("label"), F.lit(1))}
    rows = rows.withColumns(names)
    points = settle(
        rows.filter("ok").groupBy("label", "k1", "k2")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.first("vec").alias("vec"))
        .withColumns({"num": F.monotonically_increasing_id(), "d": F.size("vec")}),
        "points",
    )
    sizes = settle(points.groupBy("label", "d").count().withColumnRenamed("count", "size"), "sizes")
    words = words or codewords(sizes.agg(F.max("size")).first()[0] or 0)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("d").to_numpy()
            for d in np.unique(dims):
                some = batch.filter(pa.array(dims == d))
                flat = some.column("vec").flatten().to_numpy(zero_copy_only=False).astype(kind)
                row, name = list_decode(unit_rows(flat.reshape(-1, d)), words, cap_height(int(d), words, cosine, miss))
                lists = pa.ListArray.from_arrays(np.append(0, np.bincount(row, minlength=some.num_rows).cumsum()).astype(np.int32), pa.array(name))
                packed = pa.array([v.tobytes() for v in flat.reshape(-1, d)], pa.binary())
                plain = [some.column(n) for n in ("label", "d", "num", "weight")]
                yield pa.record_batch([*plain, packed, lists], names=["label", "d", "num", "weight", "vec", "filters"])

    label_type = df.schema[label_col].dataType.simpleString()
    out = f"label {label_type}, d int, num long, weight long, vec binary, filters array<int>"
    coded = settle(points.select("label", "d", "num", "weight", "vec").mapInArrow(decode, out), "coded")
    # Classes whose vectors would meet more tiles than they have filters; there are few, since each is large.
    large = sizes.filter(F.col("size") > tile * shared).select("label", "d", F.ceil(F.col("size") * shared / tile).cast("int").alias("parts"))
    coded = coded.join(settle(large, "large"), ["label", "d"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))

    def with_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("filters")
            row = lists.value_parent_indices().to_numpy()
            of = part_of(lists.flatten().to_numpy(), batch.column("parts").to_numpy()[row])
            pairs = np.unique(row * (1 << 31) + of)
            yield pa.record_batch(
                [*batch.take(pa.array(pairs >> 31)).columns, pa.array((pairs & ((1 << 31) - 1)).astype(np.int32))],
                names=[*batch.schema.names, "part"],
            )

    entries = coded.select("label", "d", "parts", "num", "weight", "vec", "filters").mapInArrow(
        with_parts, f"label {label_type}, d int, parts int, num long, weight long, vec binary, filters array<int>, part int"
    )
    full = entries.groupBy("label", "d", "part").count().filter(F.col("count") > tile)
    full = settle(full.select("label", "d", "part", F.ceil(F.col("count") / tile).cast("int").alias("tiles")), "full")
    held = entries.join(full, ["label", "d", "part"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    held = held.withColumn("own", F.pmod(F.xxhash64("num"), "tiles").cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    held = held.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "tiles")
    found = settle(meet(held, kind, cosine), "found")

    counts = found.groupBy(F.col("a").alias("num")).agg(F.sum("n").alias("n"))
    labels = components(found.filter("a <> b").select("a", "b"))
    linked = points.select("num", "least").join(labels, F.col("num") == F.col("vertex"))
    # Written, so that Spark knows its size and need not deal a large component's vectors out by its label.
    least = settle(linked.groupBy(F.col("label")).agg(F.min("least").alias("root")), "roots")
    roots = linked.join(least, "label").select("num", "root")
    known = (
        points.select("num", "k1", "k2", "weight", "least").withColumnRenamed("least", "own_least")
        .join(counts, "num", "left").join(roots, "num", "left")
        .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "own_least").alias("component_id"))
    )
    lone = rows.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    joined = rows.filter("ok").select("vec_id", "k1", "k2").join(known, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    return joined.unionByName(lone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query("op11_embedding_near_dedup")
def op11(spark, sf_dir):
    """Links and component of every vector among those of its label."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
