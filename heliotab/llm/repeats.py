"""Repeated passages, removed by Relative Lempel-Ziv parsing against reference blocks.

A symbol of the parse is a whole window of ``WINDOW`` consecutive words, so a factor of n symbols is a
passage of n + WINDOW - 1 words and every factor is long enough; a window across the boundary of two
factors is a symbol itself and is looked up like any other.

A block is indexed by a suffix array of all its symbols, whose neighbours give the longest match of a
place and where it lies. Each part of a document is factored greedily: the longest match from its first
open symbol, then on behind it; a symbol without a match is a literal. So a factor is one passage that
occurs as a whole at another place, its source, and the words that go are those of the factors; windows
are counted only in the sample that fills block 0 (below). A window that spans the boundary of two factors is the first symbol behind the
boundary or inside a factor, so it is looked up by the parse itself. A part ends where the block
changes, hence a passage of several blocks gives several factors.

The corpus is its own reference, cut into blocks such that equal windows meet in one block. The block of
a window is its anchor, the least hash among its word groups (a minimizer), so a document is parsed
against every block that can hold one of its windows, and consecutive windows mostly share a block. The
windows that a sample of documents shows to be very frequent form block 0, which is broadcast (at most
``KNOWN_MOST`` hashes, each with one place in the sample, so its longest match runs along that place;
the place itself has itself as source): they are factored where the document is read and are not shuffled, so no block
receives the occurrences of a passage that a third of all documents share. A line shorter than a window
may still be the anchor of many windows that differ around it: a block that a sample of documents
(``SAMPLE_DOCS`` or a 64th, whichever is more) shows to be larger than ``CROWDED`` windows is cut into
blocks by bits of the window hash, which keeps equal windows together but gives shorter factors. The
samples decide only where a window is looked up, never whether it counts.

Words are compared by 64-bit hashes; a window by its anchor's 64 bits and 40 bits of its own, or by 64
bits in block 0.

Defined results: a null or blank text has no words; a text shorter than a window keeps all; repeated
rows repeat each other's windows and each give a row; an empty table gives no rows; other columns are
not read.
"""

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decontaminate import COMPARED, compare, suffix_array
from .registry import query, table
from .textbytes import MULT, NOT_SPACE, binary_array, mix, slices, span_hashes, text_bytes, window_hashes, word_blocks, word_spans

WINDOW = 35
GROUP = 6  # words of an anchor
SAMPLE_DOCS = 4_000
FREQUENT = 8  # occurrences in the sample
KNOWN_MOST = 1 << 20
CROWDED = 1 << 18  # windows of a block
SYMBOL = 5  # bytes
PIECE = 1 << 20  # windows handled at a time
PLACE = np.uint64((1 << 22) - 1)
SOURCE = np.dtype([("th", "<i8"), ("begin", "<i4")])  # text hash and first word of the passage that a factor repeats


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, at = text_bytes(column)
    starts, ends, rows = word_spans(data, at, NOT_SPACE)
    return span_hashes(data, starts, ends), rows


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, in a logarithmic number of passes."""
    least, size = values, 1
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def windows(column: pa.Array, width: int, group: int):
    """For pieces of the texts: word and row of each whole window, its hash, its anchor and the anchor's place."""
    words, rows = words_of(column)
    row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    for lo in range(0, len(words) - width + 1, PIECE):
        part = words[lo : lo + PIECE + width - 1]
        hashes = window_hashes(part, width)
        groups = window_hashes(part, group)
        key = (groups & ~PLACE) | np.arange(len(groups), dtype=np.uint64)  # the first of equal ones
        place = (sliding_least(key, width - group + 1) & PLACE).astype(np.int64)
        at = np.arange(lo, lo + len(hashes))
        own = row_of[at]
        whole = at + width <= rows[own + 1]
        yield at[whole] - rows[own[whole]], own[whole], hashes[whole], groups[place[whole]], lo + place[whole]


def runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of runs, given where a new one begins."""
    first = np.flatnonzero(breaks)
    return first, np.diff(np.append(first, len(breaks)))


def longest(symbols: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the runs (``new`` begins one): symbols of its longest match at another place (0: none), and that place.

    The index is a suffix array over all symbols; a suffix ends with its run, and the longest match is with a neighbour.
    """
    begin, length = runs(new)
    where = np.arange(len(symbols)) + np.cumsum(new) - 1  # a 0 after each run
    text = np.zeros(len(symbols) + len(begin) + int(length.max()) + COMPARED + 64, np.int64)
    text[where] = symbols + 1
    order = suffix_array(text, where, int(symbols.max()) + 1, int(length.max()))
    _, agree = compare(text, order[:-1], text, order[1:], np.full(len(order) - 1, length.max()))
    before, after = np.concatenate(([0], agree)), np.concatenate((agree, [0]))
    order = np.searchsorted(where, order)
    reach, source = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    reach[order] = np.maximum(before, after)
    source[order] = np.where(before >= after, np.roll(order, 1), np.roll(order, -1))
    return reach, source


def greedy(symbols: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First places, lengths and sources of the factors of runs of symbols; symbols that match nothing are literals between them."""
    reach, source = longest(symbols, new)
    begin, length = runs(new)
    matched = np.append(np.flatnonzero(reach), len(symbols))
    firsts, here, stop = [], begin, begin + length
    while len(here):
        here = matched[np.searchsorted(matched, here)]  # past literals
        open_ = here < stop
        here, stop = here[open_], stop[open_]
        firsts.append(here)
        here = here + reach[here]
    first = np.concatenate(firsts)
    return first, reach[first], source[first]


def frequent(rows: DataFrame, width: int, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that the sample holds often: hashes, numbers that count on along a passage, and sources."""
    total = max(1, rows.count())
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", "th"), F.lit(total)) < SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                th = part.column(1).to_numpy()
                for word, row, hashes, _, _ in windows(part.column(2), width, group):
                    seen, at, n = np.unique(hashes, return_index=True, return_counts=True)
                    columns = [seen.view(np.int64), n, th[row[at]], word[at].astype(np.int32)]
                    yield pa.record_batch(list(map(pa.array, columns)), names=["w", "n", "th", "begin"])

    counts = sample.mapInArrow(run, "w long, n long, th long, begin int").groupBy("w")
    counts = counts.agg(F.sum("n").alias("n"), F.min(F.struct("th", "begin")).alias("at")).filter(F.col("n") >= FREQUENT)
    got = counts.orderBy(F.desc("n"), "w").limit(KNOWN_MOST).select("w", "at.*").toArrow()
    source = np.empty(got.num_rows, SOURCE)
    source["th"], source["begin"] = got.column("th").to_numpy(), got.column("begin").to_numpy()
    hashes = got.column("w").to_numpy().view(np.uint64)
    order = np.lexsort((source["begin"], source["th"]))
    th, begin = source["th"][order], source["begin"][order]
    step = np.full(len(order), 2)
    step[1:] -= (th[1:] == th[:-1]) & (begin[1:] == begin[:-1] + 1)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(step)
    by_hash = np.argsort(hashes)
    return hashes[by_hash], number[by_hash], source[by_hash]


def crowded(rows: DataFrame, known: np.ndarray, width: int, group: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of more than ``CROWDED`` windows that are not ``known``, by a sample, and into how many bits they are cut."""
    total = max(1, rows.count())
    most = min(total, max(SAMPLE_DOCS, total >> 6))
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", "th"), F.lit(total)) < most)
    sent = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                for _, _, hashes, anchor, _ in windows(part.column(2), width, group):
                    seen, n = np.unique(anchor[~np.isin(hashes, sent.value)], return_counts=True)
                    yield pa.record_batch([pa.array(seen.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    counts = sample.mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    got = counts.filter(F.col("n") * total > F.lit(CROWDED * most)).toArrow()
    anchors = got.column("anchor").to_numpy().view(np.uint64)
    bits = np.ceil(np.log2(got.column("n").to_numpy() * (total / max(1, most)) / CROWDED)).astype(np.uint64)
    order = np.argsort(anchors)
    return anchors[order], np.minimum(bits[order], 64 - 8 * SYMBOL)


def cut(anchor: np.ndarray, hashes: np.ndarray, crowds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The block of each window: its anchor, mixed with bits of its hash (none that a symbol holds) where the anchor is crowded."""
    anchors, bits = crowds
    if not len(anchors):
        return anchor
    at = np.minimum(np.searchsorted(anchors, anchor), len(anchors) - 1)
    some = np.flatnonzero(anchors[at] == anchor)
    low = hashes[some] & ((np.uint64(1) << bits[at[some]]) - np.uint64(1))
    anchor = anchor.copy()
    anchor[some] = mix(anchor[some] + low * np.uint64(MULT))
    return anchor


def parts(rows: DataFrame, width: int = WINDOW, group: int = GROUP) -> DataFrame:
    """(anchor, doc_id, th, begin, n, symbols): runs of windows by their block; n is 0 where they are still to be looked up."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    frequent_ = frequent(rows, width, group)
    known = rows.sparkSession.sparkContext.broadcast((*frequent_, crowded(rows, frequent_[0], width, group)))
    schema = f"anchor long, doc_id {kind}, th long, begin int, n int, symbols binary"
    names = ["anchor", "doc_id", "th", "begin", "n", "symbols"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number, source, crowds = known.value
        maybe = np.zeros(1 << 22, bool)
        maybe[block >> np.uint64(42)] = True
        for batch in batches:
            for part in slices(batch, 2):
                ids, th = part.column(0), part.column(1).to_numpy()
                for word, row, hashes, anchor, place in windows(part.column(2), width, group):
                    if not len(word):
                        continue
                    anchor = cut(anchor, hashes, crowds)
                    hit = maybe[hashes >> np.uint64(42)]
                    some = np.flatnonzero(hit)
                    at = np.searchsorted(block, hashes[some])
                    if len(some):
                        at = np.minimum(at, len(block) - 1)
                        hit[some] = block[at] == hashes[some]
                        at = at[hit[some]]
                    for mine, factored in ((~hit, False), (hit, True)):
                        w, r = word[mine], row[mine]
                        if not len(w):
                            continue
                        new = np.ones(len(w), bool)
                        new[1:] = (w[1:] != w[:-1] + 1) | (r[1:] != r[:-1])
                        if factored:
                            new[1:] |= number[at][1:] != number[at][:-1] + 1
                        else:
                            new[1:] |= (place[mine][1:] != place[mine][:-1]) | (anchor[mine][1:] != anchor[mine][:-1])
                        first, n = runs(new)
                        if factored:
                            key, symbols, size = th[r[first]], source[at][first].view(np.uint8), np.full(len(first), SOURCE.itemsize)
                        else:
                            key, size = anchor[mine][first].view(np.int64), n * SYMBOL
                            symbols = (hashes[mine] >> np.uint64(64 - 8 * SYMBOL)).view(np.uint8).reshape(-1, 8)[:, :SYMBOL].ravel()
                        yield pa.record_batch(
                            [
                                pa.array(key), ids.take(pa.array(r[first])), pa.array(th[r[first]]), pa.array(w[first].astype(np.int32)),
                                pa.array((n if factored else 0 * n).astype(np.int32)),
                                binary_array(symbols, np.concatenate(([0], np.cumsum(size)))),
                            ],
                            names=names,
                        )

    return rows.mapInArrow(parse, schema)


def factors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, group: int = GROUP) -> DataFrame:
    """(doc_id, th, begin, n, of_th, of_begin): passages of n windows, by their first word, and where each occurs as a whole too."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Look the symbols of each block's parts up in the index of the block's symbols."""
        held: list[pa.RecordBatch] = []

        def done(rows_: pa.RecordBatch) -> pa.RecordBatch | None:
            anchor = rows_.column(0).to_numpy()
            same = anchor[1:] == anchor[:-1]
            met = np.concatenate((same, [False])) | np.concatenate(([False], same))
            n = rows_.column(4).to_numpy()
            ready, open_ = np.flatnonzero(n > 0), np.flatnonzero(met & (n == 0))
            first_row, first, size = [ready], [np.zeros(len(ready), np.int64)], [n[ready]]
            th, word = rows_.column(2).to_numpy(), rows_.column(3).to_numpy()
            known_at = np.frombuffer(b"".join(rows_.column(5).take(pa.array(ready)).to_pylist()), SOURCE)
            of_th, of_begin = [known_at["th"]], [known_at["begin"]]
            if len(open_):
                held_symbols = rows_.column(5).take(pa.array(open_))
                at = np.frombuffer(held_symbols.buffers()[1], np.int64, len(open_) + 1) // SYMBOL
                raw = np.frombuffer(held_symbols.buffers()[2], np.uint8)[SYMBOL * at[0] : SYMBOL * at[-1]].reshape(-1, SYMBOL)
                at = at - at[0]
                wide = np.zeros((len(raw), 8), np.uint8)
                wide[:, :SYMBOL] = raw
                block = np.cumsum(np.concatenate(([0], anchor[open_][1:] != anchor[open_][:-1])))
                of = np.repeat(np.arange(len(open_)), np.diff(at))
                key = wide.view(np.uint64).ravel() | (block[of].astype(np.uint64) << np.uint64(8 * SYMBOL))
                _, rank = np.unique(key, return_inverse=True)
                begins = np.zeros(len(key), bool)
                begins[at[:-1]] = True
                begin, length, source = greedy(rank, begins)
                first_row.append(open_[of[begin]])
                first.append(begin - at[of[begin]])
                size.append(length)
                of_th.append(th[open_[of[source]]])
                of_begin.append(word[open_[of[source]]] + source - at[of[source]])
            row = np.concatenate(first_row)
            if not len(row):
                return None
            take = pa.array(row)
            ints = [word[row] + np.concatenate(first), np.concatenate(size), np.concatenate(of_begin)]
            begin, n, of_begin = (pa.array(x.astype(np.int32)) for x in ints)
            return pa.record_batch(
                [rows_.column(1).take(take), rows_.column(2).take(take), begin, n, pa.array(np.concatenate(of_th)), of_begin],
                names=["doc_id", "th", "begin", "n", "of_th", "of_begin"],
            )

        def joined() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            whole = whole.set_column(5, "symbols", whole.column(5).cast(pa.large_binary())).combine_chunks().to_batches()
            if len(whole) != 1:
                raise ValueError("ids of a block exceed one Arrow array")
            return whole[0]

        for batch in batches:
            # Blocks end where the anchor changes; the last one may go on in the next batch.
            anchor = batch.column(0).to_numpy()
            change = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            begins_new = bool(held) and held[-1].column(0)[held[-1].num_rows - 1].as_py() != anchor[0]
            end = int(change[-1]) if len(change) else 0
            if end or begins_new:
                if end:
                    held.append(batch.slice(0, end))
                if (out := done(joined())) is not None:
                    yield out
                held = []
            held.append(batch.slice(end))
        if held and (out := done(joined())) is not None:
            yield out

    return (
        parts(rows, width, group)
        .repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(match, f"doc_id {kind}, th long, begin int, n int, of_th long, of_begin int")
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, group: int = GROUP) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every text without the words of repeated windows."""
    found = factors(docs, id_col, text_col, width, group)
    # Equal rows have equal factors, so a set per row is bounded by the row's text.
    spans = found.groupBy("doc_id", "th").agg(F.collect_set(F.struct("begin", "n")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "spans")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    ready = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    kind = docs.schema[id_col].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            n_words, n_removed, kept = [], [], []
            for a, b, marked in zip(at[:-1], at[1:], batch.column(2).to_pylist()):
                text, seen, gone, out = data[a:b].tobytes(), 0, 0, []
                if marked:
                    begin = np.array([s["begin"] for s in marked])
                    end = begin + np.array([s["n"] for s in marked]) + width - 1
                    change = np.bincount(begin, minlength=end.max() + 1) - np.bincount(end)
                    stays = np.cumsum(change) == 0
                for words in word_blocks(text):
                    if marked:
                        mask = stays[seen : seen + len(words)]
                        left = list(compress(words, np.append(mask, np.ones(len(words) - len(mask), bool)).tolist()))
                    else:
                        left = words
                    seen += len(words)
                    gone += len(words) - len(left)
                    if left:
                        out.append(b" ".join(left))
                n_words.append(seen)
                n_removed.append(gone)
                kept.append(b" ".join(out))
            columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.record_batch([batch.column(0), *columns], names=["doc_id", "n_words", "n_removed", "kept"])

    return ready.select("doc_id", "text", "spans").mapInArrow(remove, f"doc_id {kind}, n_words long, n_removed long, kept string")


SQL = r"""
WITH doc AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 34), ' ')) AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM doc WHERE len(w) >= 35)),
twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS p FROM win JOIN twice USING (s)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc.doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""


@query("op6_substring_dedup", SQL)
def op6(spark, sf_dir):
    """Words of every document that no repeated window covers."""
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
