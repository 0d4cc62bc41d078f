"""Toxicity scores from a small convolutional text classifier, trained in NumPy.

A word is the sum of hashed embeddings of itself and of its first bytes. Filters of several widths run
over the word vectors, the largest response of each filter over the whole text is kept, and a logistic
layer scores those maxima. A score of 0.5 is the threshold of the text's language, which is predicted
from the text (``langid``) and calibrated on labelled rows kept out of the training.

The net starts warm: one dimension of the embedding holds naive-Bayes log-odds of all training texts, and
the filters and the logistic layer begin as their sum; everything else starts at random, and all of it is
trained.

The model is learned from all labelled texts, whole, equal rows once. The language filters count all of
them; a hash of id and text gives about ``ASIDE`` tenths to the thresholds and the rest to the net. The net is
trained in shards of about ``SHARD_ROWS`` texts that start alike, and their results are averaged: an
embedding by how often each shard holds its bucket, the rest by texts. The thresholds are exact over all texts
kept aside, found with distributed running counts. Scoring reads whole texts of all documents; a text is
walked in blocks of words, so its length does not bound it.

Defined results: a null, empty or wordless text gets the score of no response at all; a document with
several labels counts as toxic if one says so; without labels of both classes every score is the share
of toxic labels (0 without labels), below 0.5 unless all are toxic; repeated rows each give a row; other
columns are not read (``remove_toxic`` passes them through).
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranks import BUCKET, cut_points, with_bucket
from ..session import settle
from .langid import TOGETHER, Filters
from .langid import fit as fit_languages
from .registry import query, table
from .textbytes import LOWER, byte_table, mix, slices, span_hashes, text_bytes, word_spans

SHARD_ROWS = 1 << 13
SHARD_BYTES = 1 << 25  # of text, on average
ASIDE = 3  # tenths of the texts
BUCKET_BITS = 16  # a bucket is two bytes
SIZE = 8  # of an embedding
FILTERS = 8  # of each width
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5, 6)  # bytes
EPOCHS = 6
BATCH = 64  # documents
RATE = 0.01
SEED = 11
BLOCK = 1 << 16  # words scored at a time
WORD_BYTES = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word of all rows (one column for the word, one for each prefix), and row offsets."""
    data, at = text_bytes(column)
    data = LOWER[data]
    starts, ends, rows = word_spans(data, at, WORD_BYTES)
    out = np.empty((len(starts), 1 + len(PREFIXES)), np.uint16)
    shift = np.uint64(64 - BUCKET_BITS)
    out[:, 0] = span_hashes(data, starts, ends) >> shift
    key = np.zeros(len(starts), np.uint64)
    for j in range(max(PREFIXES)):
        inside = starts + j < ends
        key |= np.where(inside, data[np.where(inside, starts + j, 0)], 0).astype(np.uint64) << np.uint64(8 * j)
        if j + 1 in PREFIXES:
            out[:, 1 + PREFIXES.index(j + 1)] = mix(key + np.uint64((j + 1) << 56)) >> shift
    return out, rows


def word_vectors(emb: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """The sum of the embeddings of each word's buckets."""
    out = np.take(emb, buckets[:, 0], axis=0)
    for k in range(1, buckets.shape[1]):
        out += np.take(emb, buckets[:, k], axis=0)
    return out


class Net:
    """Embeddings, filters, and the logistic layer over pooled responses."""

    def __init__(self, emb: np.ndarray, filters: list, bias: np.ndarray, out: np.ndarray, base: float):
        self.emb, self.filters, self.bias, self.out, self.base = emb, filters, bias, out, base

    @classmethod
    def start(cls, rng: np.random.Generator) -> "Net":
        emb = rng.normal(0, 0.1, (1 << BUCKET_BITS, SIZE)).astype(np.float32)
        filters = [rng.normal(0, 0.5 / w, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        return cls(emb, filters, np.zeros(n, np.float32), rng.normal(0, 0.3, n).astype(np.float32), 0.0)

    def pooled(self, buckets: np.ndarray, rows: np.ndarray):
        """Largest response of every filter over each document, and the word where it is."""
        docs, n = len(rows) - 1, len(buckets)
        best = np.zeros((docs, len(self.bias)), np.float32)  # a negative response counts as none
        place = np.full(best.shape, -1, np.int64)
        ends = np.repeat(rows[1:], np.diff(rows))
        for lo in range(0, n, BLOCK):
            hi = min(lo + BLOCK, n)
            vectors = word_vectors(self.emb, buckets[lo : min(hi + max(WIDTHS) - 1, n)])
            first = np.searchsorted(rows, lo, "right") - 1
            last = np.searchsorted(rows, hi, "left")
            edges = np.maximum(rows[first:last], lo) - lo
            full = np.flatnonzero(np.diff(np.append(edges, hi - lo)) > 0)
            for f, (w, weights) in enumerate(zip(WIDTHS, self.filters)):
                response = vectors[: hi - lo] @ weights[0]
                for j in range(1, w):
                    m = min(hi - lo, len(vectors) - j)
                    more = vectors[j : j + m] @ weights[j]
                    more[np.arange(lo, lo + m) + j >= ends[lo : lo + m]] = 0  # beyond the document
                    response[:m] += more
                cols = slice(f * FILTERS, (f + 1) * FILTERS)
                response += self.bias[cols]
                most = np.maximum.reduceat(response, edges[full], axis=0)
                at = first + full
                better = most > best[at, cols]
                if better.any():
                    found = np.repeat(np.arange(len(full)), np.diff(np.append(edges[full], hi - lo)))
                    d, c = np.nonzero(better)
                    best[at[d], f * FILTERS + c] = most[d, c]
                    if self.keep_places:
                        same = response == most[found]
                        for k in range(FILTERS):
                            w_at = np.flatnonzero(same[:, k])
                            g, i = np.unique(found[w_at], return_index=True)
                            ok = better[g, k]
                            place[at[g[ok]], f * FILTERS + k] = lo + w_at[i[ok]]
        return best, place

    keep_places = False

    def logits(self, buckets: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.pooled(buckets, rows)[0] @ self.out + self.base


def bucket_counts(buckets: np.ndarray, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Documents with each bucket, and those of the toxic class, by column of ``buckets``."""
    out = np.zeros((2, buckets.shape[1], 1 << BUCKET_BITS))
    for k in range(buckets.shape[1]):
        for lo in range(0, len(y), BATCH):
            own = rows[lo : lo + BATCH + 1]
            doc = np.repeat(np.arange(len(own) - 1), np.diff(own))
            pair = np.unique(doc << BUCKET_BITS | buckets[own[0] : own[-1], k])
            b, d = pair & ((1 << BUCKET_BITS) - 1), pair >> BUCKET_BITS
            np.add.at(out[0, k], b, 1)
            np.add.at(out[1, k], b, y[lo + d])
    return out


def occurrences(buckets: np.ndarray) -> np.ndarray:
    """How often each bucket is held; counted in blocks, as ``bincount`` makes eight bytes of every two."""
    out = np.zeros(1 << BUCKET_BITS)
    for lo in range(0, len(buckets), BLOCK):
        out += np.bincount(buckets[lo : lo + BLOCK].ravel(), minlength=len(out))
    return out


def start_values(net: Net, counts: np.ndarray, rate: float) -> None:
    """The warm start: the first dimension gets the log-odds of buckets whose documents clearly lean to the toxic class."""
    for seen, bad in zip(*counts):
        z = (bad - seen * rate) / np.sqrt(np.maximum(seen * rate * (1 - rate), 1e-9))
        odds = np.log((bad + rate) / (seen - bad + 1 - rate)) - np.log(rate / (1 - rate))
        net.emb[:, 0] += np.where(z > 5, odds, 0).astype(np.float32)
    for weights in net.filters:
        weights[:, 0, 0] = 0.5
    net.out[:: FILTERS] = 1.0
    net.base = -1.0


def started(counts: np.ndarray, rate: float) -> Net:
    net = Net.start(np.random.default_rng(SEED))
    start_values(net, counts, rate)
    return net


def train_net(
    buckets: np.ndarray, rows: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, net: Net | None = None, rate: float | None = None
) -> Net:
    """Adam on the logistic loss, each class weighted alike; gradients flow through the maxima only.

    ``net`` is trained on (the warm start of these documents by default); ``rate`` is the share of toxic documents.
    """
    share = y.mean() if rate is None else rate
    net = net or started(bucket_counts(buckets, rows, y), share)
    net.keep_places = True
    rng = np.random.default_rng(SEED)
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    params = [net.emb, *net.filters, net.bias, net.out]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    base_m = base_v = 0.0
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            docs = order[lo : lo + BATCH]
            size = rows[docs + 1] - rows[docs]
            own = np.concatenate(([0], np.cumsum(size)))
            take = np.repeat(rows[docs] - own[:-1], size) + np.arange(own[-1])
            mine = buckets[take]
            pooled, place = net.pooled(mine, own)
            z = pooled @ net.out + net.base
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            g = ((p - y[docs]) * weight[docs] / len(docs)).astype(np.float32)
            grads = [np.zeros_like(x) for x in params]
            grads[-1] += pooled.T @ g
            back = np.where(place >= 0, g[:, None] * net.out, 0).astype(np.float32)
            grads[-2] += back.sum(axis=0)
            for f, w in enumerate(WIDTHS):
                cols = np.arange(f * FILTERS, (f + 1) * FILTERS)
                d, c = np.nonzero(place[:, cols] >= 0)
                at, b = place[d, cols[c]], back[d, cols[c]]
                for j in range(w):
                    ok = at + j < own[d + 1]
                    words = mine[at[ok] + j]
                    vectors = word_vectors(net.emb, words)
                    np.add.at(grads[1 + f][j].T, c[ok], vectors * b[ok, None])
                    toward = net.filters[f][j][:, c[ok]].T * b[ok, None]
                    for k in range(words.shape[1]):
                        np.add.at(grads[0], words[:, k], toward)
            step += 1
            for x, gr, m, v in zip(params, grads, first, second):
                m += 0.1 * (gr - m)
                v += 0.001 * (gr * gr - v)
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                x -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
            gb = float(g.sum())
            base_m += 0.1 * (gb - base_m)
            base_v += 0.001 * (gb * gb - base_v)
            net.base -= RATE * (base_m / (1 - 0.9**step)) / (np.sqrt(base_v / (1 - 0.999**step)) + 1e-8)
    net.keep_places = False
    return net


def threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest stretch of cuts with the best balanced accuracy."""
    order = np.argsort(z)
    z, y = z[order], y[order]
    bad, good = max(1, y.sum()), max(1, (1 - y).sum())
    below_bad = np.concatenate(([0], np.cumsum(y)))
    below_good = np.concatenate(([0], np.cumsum(1 - y)))
    value = (bad - below_bad) / bad + below_good / good
    edges = np.concatenate(([z[0] - 1], z, [z[-1] + 1]))
    width = np.diff(edges)
    value[width <= 0] = -1  # between equal values there is no cut
    best = np.flatnonzero(value >= value.max() - 1e-12)
    k = best[np.argmax(width[best])]
    return float((edges[k] + edges[k + 1]) / 2)


def thresholds(scored: DataFrame, key: str = "lang", z: str = "z", y: str = "y") -> dict:
    """``threshold`` of the rows of each key, with the rows of both classes: {key: (cut, toxic, others)}.

    Equal values are counted, values are cut into buckets at sketched quantiles and ordered within them, so no
    task or window holds a key; the sketch affects balance only.
    """
    counts = scored.groupBy(key, z).agg(F.sum(y).cast("double").alias("bad"), F.sum(1 - F.col(y)).cast("double").alias("good"))
    rows = settle(counts, "margins")
    rows = with_bucket(rows, z, cut_points(rows, z))
    totals = rows.groupBy(key, BUCKET).agg(F.sum("bad").alias("_bad"), F.sum("good").alias("_good"), F.max(z).alias("_last"))
    whole = Window.partitionBy(key)
    earlier = whole.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        key, BUCKET, F.max("_last").over(earlier).alias("_last"), F.max("_last").over(whole).alias("_most"),
        *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0.0)).alias(f"_{c}") for c in ("bad", "good")],
        *[F.sum(f"_{c}").over(whole).alias(f"all_{c}") for c in ("bad", "good")],
    )
    inside = Window.partitionBy(key, BUCKET).orderBy(z)
    below = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select(
        key, BUCKET, F.col(z).alias("_z"), F.lag(z).over(inside).alias("_before"),
        *[F.coalesce(F.sum(c).over(below), F.lit(0.0)).alias(c) for c in ("bad", "good")],
    ).join(F.broadcast(offsets), [key, BUCKET])
    # The cut below each value, and one above the largest; the value of a cut is its balanced accuracy, doubled.
    bad, good = (F.greatest(F.lit(1.0), F.col(f"all_{c}")) for c in ("bad", "good"))
    value = (bad - F.col("bad") - F.col("_bad")) / bad + (F.col("good") + F.col("_good")) / good
    under = F.struct(value.alias("value"), F.coalesce("_before", "_last", F.col("_z") - 1).alias("low"), F.col("_z").alias("high"))
    top = F.struct(((bad - F.col("all_bad")) / bad + F.col("all_good") / good).alias("value"), F.col("_z").alias("low"), (F.col("_z") + 1).alias("high"))
    cuts = F.when(F.col("_z") == F.col("_most"), F.array(under, top)).otherwise(F.array(under))
    cuts = settle(local.select(key, "all_bad", "all_good", F.explode(cuts).alias("c")).select(key, "all_bad", "all_good", "c.*"), "cuts")
    best = cuts.groupBy(key).agg(F.max("value").alias("_best"))
    wide = F.struct((F.col("high") - F.col("low")).alias("width"), (-F.col("low")).alias("low"))
    found = cuts.join(F.broadcast(best), key).filter(F.col("value") >= F.col("_best") - 1e-12).groupBy(key)
    found = found.agg(F.max_by((F.col("low") + F.col("high")) / 2, wide).alias("cut"), F.max("all_bad").alias("bad"), F.max("all_good").alias("good"))
    return {r[key]: (r.cut, r.bad, r.good) for r in found.collect()}


LEAST_LABELS = 20  # of each class, for a language to have a threshold of its own
GENERAL = -1  # stands for all languages
PIECE = 1 << 16  # values of a vector that travel together
PIECES = "piece int, source long, content binary"


def pieces_of(vector: np.ndarray, source: int) -> Iterator[pa.RecordBatch]:
    """A vector as rows of ``PIECES``."""
    for i, lo in enumerate(range(0, len(vector), PIECE)):
        content = pa.array([vector[lo : lo + PIECE].astype(np.float64).tobytes()], pa.binary())
        yield pa.record_batch([pa.array([i], pa.int32()), pa.array([source], pa.int64()), content], names=["piece", "source", "content"])


def summed(parts: DataFrame) -> np.ndarray:
    """The sum of the vectors in rows of ``PIECES``, in the order of their sources; a task holds one piece."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.record_batch([pa.array([at], pa.int32()), pa.array([held.tobytes()], pa.binary())], names=["piece", "content"])

        at, held = None, None
        for batch in batches:
            for piece, content in zip(batch.column(0).to_pylist(), batch.column(2)):
                values = np.frombuffer(content.as_buffer(), np.float64)
                if piece == at:
                    held += values
                    continue
                if at is not None:
                    yield out()
                at, held = piece, values.copy()
        if at is not None:
            yield out()

    dealt = parts.repartition("piece").sortWithinPartitions("piece", "source")
    found = sorted(dealt.mapInArrow(add, "piece int, content binary").collect())
    return np.concatenate([np.frombuffer(bytes(r.content), np.float64) for r in found])


def plain(net: Net) -> dict:
    return {"emb": net.emb, "filters": net.filters, "bias": net.bias, "out": net.out, "base": net.base}


def copy_of(m: dict) -> Net:
    return Net(m["emb"].copy(), [f.copy() for f in m["filters"]], m["bias"].copy(), m["out"].copy(), m["base"])


def start_net(learned: DataFrame, rate: float) -> Net:
    """The warm start, from counts over all rows of ``learned`` (text, y)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in slices(batch, 0, TOGETHER):
                own = bucket_counts(*features(part.column(0)), part.column(1).to_numpy().astype(np.float64))
                total = own if total is None else np.add(total, own, out=total)
        if total is not None:
            yield from pieces_of(total.ravel(), TaskContext.get().partitionId())

    counts = summed(learned.select("text", "y").mapInArrow(count, PIECES))
    return started(counts.reshape(2, 1 + len(PREFIXES), 1 << BUCKET_BITS), rate)


def trained_net(learned: DataFrame, start: Net, rate: float, shards: int) -> Net:
    """Each shard of ``learned`` (shard, place, text, y) trains a copy of the start; the mean of the results."""
    sent = learned.sparkSession.sparkContext.broadcast(plain(start))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result():
            buckets, size, y = (np.concatenate(x) for x in zip(*got))
            got.clear()
            net = train_net(buckets, np.concatenate(([0], np.cumsum(size))), y, net=copy_of(sent.value), rate=rate)
            held = occurrences(buckets)
            moved = (net.emb.astype(np.float64) - sent.value["emb"]) * held[:, None]
            rest = np.concatenate([*(f.ravel() for f in net.filters), net.bias, net.out, [net.base]]).astype(np.float64)
            return np.concatenate([moved.ravel(), held, rest * len(y), [len(y)]])

        shard, got = None, []
        for batch in batches:
            for part in slices(batch, 1, TOGETHER):
                numbers = part.column(0).to_numpy()
                edges = np.flatnonzero(np.diff(numbers)) + 1
                for lo, hi in zip([0, *edges], [*edges, len(numbers)]):
                    if got and numbers[lo] != shard:
                        yield from pieces_of(result(), shard)
                    shard, own = int(numbers[lo]), part.slice(lo, hi - lo)
                    b, r = features(own.column(1))
                    got.append((b, np.diff(r), own.column(2).to_numpy().astype(np.float64)))
        if got:
            yield from pieces_of(result(), shard)

    dealt = learned.select("shard", "text", "y", "place").repartitionById(shards, F.col("shard").cast("int"))
    dealt = dealt.sortWithinPartitions("shard", "place", "text").select("shard", "text", "y")
    total = summed(dealt.mapInArrow(fit, PIECES))
    moved, held, rest = np.split(total[:-1], np.cumsum([start.emb.size, 1 << BUCKET_BITS]))
    net, rest = copy_of(plain(start)), rest / total[-1]
    net.emb += (moved.reshape(net.emb.shape) / np.maximum(held, 1)[:, None]).astype(np.float32)
    for x in (*net.filters, net.bias, net.out):
        x[...], rest = rest[: x.size].reshape(x.shape), rest[x.size :]
    net.base = float(rest[0])
    return net


def margins(aside: DataFrame, net: Net, languages: dict | None) -> DataFrame:
    """Predicted language, response and label of each row of ``aside`` (text, y); every row a second time as ``GENERAL``."""
    sent = aside.sparkSession.sparkContext.broadcast((plain(net), languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, langs = copy_of(sent.value[0]), Filters(**sent.value[1]) if sent.value[1] else None
        for batch in batches:
            for part in slices(batch, 0, TOGETHER):
                guess = langs.predict(part.column(0))[0] if langs else np.zeros(part.num_rows, np.int64)
                z = own.logits(*features(part.column(0))).astype(np.float64)
                yield pa.record_batch([pa.array(guess.astype(np.int32)), pa.array(z), part.column(1)], names=["lang", "z", "y"])

    found = aside.select("text", "y").mapInArrow(run, "lang int, z double, y int")
    return found.select(F.explode(F.array("lang", F.lit(GENERAL))).alias("lang"), "z", "y")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    label_col: str = "toxic", shard_rows: int = SHARD_ROWS,
) -> dict:
    """The model as plain values, from all rows of ``docs`` that ``labels`` covers."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter(F.col("text").isNotNull()).withColumn("th", F.xxhash64("text"))
    covered = settle(rows.select("id", "th").distinct().join(known, "id"), "labelled")
    # One row of each id and text, so that repeated rows do not swell a shard; a hot id has its texts in all shards.
    # Merged at any size, so that disk grows with the input and no list of labels is held whole.
    once = rows.join(covered.hint("merge"), ["id", "th"]).groupBy("id", "th")
    once = once.agg(F.min("text").alias("text"), F.min("lang").alias("lang"), F.max("y").alias("y"))
    place = F.xxhash64("id", "th", F.lit(SEED))
    once = settle(once.withColumns({"place": place, "aside": F.pmod(F.shiftright(place, 32), F.lit(10)) < ASIDE}), "labelled-text")
    sizes = {(r.y, r.aside): r for r in once.groupBy("y", "aside").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()}
    total = sum(r.n for r in sizes.values())
    if len({y for y, _ in sizes}) < 2:
        return {"languages": None, "net": None, "share": sum(r.n * y for (y, _), r in sizes.items()) / total if total else 0.0}
    # Too few rows to leave some aside: all of them serve both ends.
    parted = all((y, side) in sizes for y in (0, 1) for side in (False, True))
    mine = [r for (_, side), r in sizes.items() if not (parted and side)]
    n = sum(r.n for r in mine)
    rate = sum(r.n for r in mine if r.y == 1) / n
    shards = max(1, math.ceil(n / shard_rows), math.ceil(sum(r.bytes for r in mine) / SHARD_BYTES))
    learned = once.filter(~F.col("aside")) if parted else once
    learned = learned.withColumn("shard", F.pmod("place", F.lit(shards)))
    filters = fit_languages(once, "id", "text", "lang", None)
    sent = vars(filters) if filters else None
    net = trained_net(learned, start_net(learned, rate), rate, shards)
    found = thresholds(margins(once.filter("aside") if parted else once, net, sent))
    general = found[GENERAL][0]
    cuts = []
    for lang in range(len(filters.languages) if filters else 1):
        cut, bad, good = found.get(lang, (general, 0, 0))
        cuts.append(cut if min(bad, good) >= LEAST_LABELS else general)
    return {"languages": sent, "net": plain(net) | {"cuts": cuts}, "share": 0.0}


def scorer(model: dict):
    """A function from a text column to scores."""
    if model["net"] is None:
        return lambda column: np.full(len(column), min(model["share"], 1.0))
    m = model["net"]
    net = Net(m["emb"], m["filters"], m["bias"], m["out"], m["base"])
    langs = Filters(**model["languages"]) if model["languages"] else None
    cuts = np.array(m["cuts"])

    def score(column: pa.Array) -> np.ndarray:
        guess = langs.predict(column)[0] if langs else np.zeros(len(column), np.int64)
        z = net.logits(*features(column)) - cuts[guess]
        return 1 / (1 + np.exp(-np.clip(z, -30.0, 30.0)))

    return score


def with_scores(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None, most: float | None = None) -> DataFrame:
    """``docs`` with the columns in ``keep`` and a score, or the rows scored below ``most`` as they are."""
    columns = docs.columns if keep is None else keep
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(sent.value)
        for batch in batches:
            for part in slices(batch, 0, TOGETHER):
                found = score(part.column(0))
                rest = pa.record_batch(part.columns[1:], names=columns) if columns else None
                if most is None:
                    yield pa.record_batch([*part.columns[1:], pa.array(found)], names=[*columns, "score"])
                else:
                    yield rest.filter(pa.array(found < most))

    kept = docs.select(*[F.col(f"`{c}`") for c in columns])
    schema = T.StructType([*kept.schema.fields, *([T.StructField("score", T.DoubleType())] if most is None else [])])
    return docs.select(F.col(text_col).alias("_text"), *[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


def remove_toxic(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    return with_scores(docs, model, text_col, None, 0.5)


def fold(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def train_on_folds(docs: DataFrame, labels: DataFrame) -> dict:
    """The model of the query: rows whose crc32 leaves no remainder by 5 are not learned from."""
    return train(docs.filter(fold() != 0), labels.filter(fold() != 0))


@query("op7_toxicity")
def op7(spark, sf_dir):
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = train_on_folds(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"))
    found = with_scores(rows, model, "text", ["doc_id", "held_out"])
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
