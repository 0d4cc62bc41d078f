"""Benchmark decontamination with suffix arrays over shards of the training text.

Every shard (a run of documents in one task) gets a suffix array of its word sequence. All suffixes of
the benchmark items are binary-searched in it; the range of suffixes that share an item's window gives
all its occurrences. Every item that shares the window is compared beyond it, from each place where a
match of that item begins, so each item has its own longest verbatim matches and their places. Words that no
item holds end a training suffix, so suffixes too short for the shortest window are not sorted.

Defined results: null texts have no words, on either side; an item without words matches nothing; an
item shorter than a window is one window; repeated items count once per id, an item without id marks
words but is not listed; repeated documents each give a row; an empty benchmark hits nothing; other
columns, whatever their names, are not read (``remove_contaminated`` passes them through).
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .registry import query, table
from .textbytes import LOWER, byte_table, slices, span_hashes, text_bytes, word_spans

WINDOW = 10
BLOCK_BYTES = 16 << 20  # benchmark text held by a task at a time
# Everything but [\x00-\x2F\x3A-\x60\x7B-\x7F].
WORD_BYTES = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
COMPARED = 8  # words compared at a time
PAIRS = 1 << 18  # places and items compared at a time


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all rows, and where each row's words begin."""
    data, at = text_bytes(column)
    data = LOWER[data]
    starts, ends, rows = word_spans(data, at, WORD_BYTES)
    return span_hashes(data, starts, ends), rows


@dataclass
class Tests:
    """Benchmark items as one sequence of word numbers, each item closed by a 0."""

    vocabulary: np.ndarray  # sorted word hashes; word number = place + 1
    symbols: np.ndarray
    starts: np.ndarray  # suffixes that begin a window
    depths: np.ndarray  # words of that window
    item: np.ndarray  # item number of each suffix
    offset: np.ndarray  # its word within the item
    names: list  # ids, None where null
    longest: int

    @classmethod
    def build(cls, ids: list, texts: list, window: int) -> "Tests":
        hashes, rows = words_of(pa.array(texts, pa.string()))
        vocabulary, numbers = np.unique(hashes, return_inverse=True)
        counts = np.diff(rows)
        where = np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)
        longest = int(counts.max(initial=0))
        symbols = np.zeros(len(hashes) + len(counts) + longest + COMPARED, np.int64)
        symbols[where] = numbers + 1
        item = np.repeat(np.arange(len(counts)), counts)
        offset = np.arange(len(hashes)) - np.repeat(rows[:-1], counts)
        depth = np.minimum(counts, window)[item]
        opens = offset + depth <= counts[item]
        return cls(vocabulary, symbols, where[opens], depth[opens], item[opens], offset[opens], ids, longest)


def packed(symbols: np.ndarray, at: np.ndarray, bits: int, words: int) -> np.ndarray:
    """The next words from each place in one integer; nothing after the end of a suffix counts."""
    key, alive = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    for j in range(words):
        x = np.where(alive, symbols[at + j], 0)
        alive &= x > 0
        key = (key << bits) | x
    return key


def suffix_array(symbols: np.ndarray, at: np.ndarray, highest: int, depth: int) -> np.ndarray:
    """The suffixes that begin at ``at``, in order of their first ``depth`` words; ties by place.

    A suffix ends at a 0. Groups that still tie are ordered by the next words, so the work beyond
    the first words falls on repeated text only.
    """
    bits = max(1, int(highest).bit_length())
    words = 62 // bits
    order = at.copy()
    group = np.zeros(len(at), np.int64)
    active = np.arange(len(at))
    done = 0
    while len(active) > 1 and done < depth:
        key = packed(symbols, order[active] + done, bits, words)
        sort = np.lexsort((order[active], key, group[active]))
        order[active], key = order[active][sort], key[sort]
        held = group[active]
        new = np.ones(len(active), bool)
        new[1:] = (held[1:] != held[:-1]) | (key[1:] != key[:-1])
        group[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
        tied = ~new
        tied[:-1] |= ~new[1:]
        tied &= (key & ((1 << bits) - 1)) > 0  # the last word is not an end
        active = active[tied]
        done += words
    return order


def compare(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, depth: np.ndarray):
    """Sign of b - a at the first differing word within ``depth`` (0 if none), and the words that agree."""
    sign, agree = np.zeros(len(a_at), np.int64), np.zeros(len(a_at), np.int64)
    open_, done = np.arange(len(a_at)), 0
    steps = np.arange(COMPARED)
    while len(open_):
        x, y = a[a_at[open_, None] + done + steps], b[b_at[open_, None] + done + steps]
        inside = done + steps < depth[open_, None]
        stop = ((x != y) | (x == 0)) & inside
        any_stop = stop.any(axis=1)
        first = np.where(any_stop, stop.argmax(axis=1), np.minimum(COMPARED, depth[open_] - done))
        agree[open_] = done + first
        hit = np.flatnonzero(any_stop)
        sign[open_[hit]] = np.sign(y[hit, first[hit]] - x[hit, first[hit]])
        done += COMPARED
        open_ = open_[~any_stop & (depth[open_] > done)]
    return sign, agree


def bound(tests: Tests, symbols: np.ndarray, suffixes: np.ndarray, at: np.ndarray, depth: np.ndarray, right: bool) -> np.ndarray:
    """Where each test suffix belongs among the training suffixes, by binary search."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(suffixes))
    while len(open_ := np.flatnonzero(low < high)):
        mid = (low[open_] + high[open_]) // 2
        sign, _ = compare(tests.symbols, at[open_], symbols, suffixes[mid], depth[open_])
        up = sign <= 0 if right else sign < 0
        low[open_[up]] = mid[up] + 1
        high[open_[~up]] = mid[~up]
    return low


@dataclass
class Hits:
    """What one shard holds of the tests."""

    covered: np.ndarray  # per word, whether an occurrence covers it
    rows: np.ndarray  # word offsets of the documents
    places: np.ndarray  # word where an occurrence of a window begins
    window: np.ndarray  # the first test suffix with that window
    suffixes_of: dict  # window -> all test suffixes that begin with it
    symbols: np.ndarray  # word numbers of the shard, 0 where no item holds the word and after each document
    at: np.ndarray  # the occurrences' places among them


def search(column: pa.Array, tests: Tests) -> Hits:
    """All occurrences of the tests' windows in the texts of one shard."""
    hashes, rows = words_of(column)
    n, empty = len(hashes), np.zeros(0, np.int64)
    if not len(tests.starts) or not n:
        return Hits(np.zeros(n, bool), rows, empty, empty, {}, empty, empty)
    place = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
    numbers = np.where(tests.vocabulary[place] == hashes, place + 1, 0)
    counts = np.diff(rows)
    where = np.arange(n) + np.repeat(np.arange(len(counts)), counts)  # a 0 after each document
    symbols = np.zeros(n + len(counts) + tests.longest + 64, np.int64)
    symbols[where] = numbers
    # Words until the suffix ends; only suffixes that can hold the shortest window are of use.
    ends = np.flatnonzero(symbols == 0)
    known = where[numbers > 0]
    left = ends[np.searchsorted(ends, known)] - known
    suffixes = suffix_array(symbols, known[left >= tests.depths.min()], len(tests.vocabulary), tests.longest)
    low = bound(tests, symbols, suffixes, tests.starts, tests.depths, False)
    high = bound(tests, symbols, suffixes, tests.starts, tests.depths, True)
    found = np.flatnonzero(low < high)
    covered = np.zeros(n + 1, np.int64)
    if not len(found):
        return Hits(covered[:n] > 0, rows, empty, empty, {}, symbols, empty)
    # Equal windows have the same range; each range is walked once.
    _, first, group = np.unique(np.stack((low[found], tests.depths[found])), axis=1, return_index=True, return_inverse=True)
    group = group.ravel()
    sharing = np.split(found[np.argsort(group, kind="stable")], np.cumsum(np.bincount(group))[:-1])
    lead = found[first]
    size = high[lead] - low[lead]
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    at = suffixes[np.repeat(low[lead], size) + step]
    window = np.repeat(lead, size)
    doc_word = np.searchsorted(where, at)
    np.add.at(covered, doc_word, 1)
    np.add.at(covered, doc_word + tests.depths[window], -1)
    return Hits(np.cumsum(covered)[:n] > 0, rows, doc_word, window, dict(zip(lead.tolist(), sharing)), symbols, at)


def longest_matches(hits: Hits, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, test suffix and length of every match that neither its words before nor those behind it extend."""
    word, suffix, size = ([np.zeros(0, np.int64)] for _ in range(3))
    if len(hits.places):
        leads = np.array(list(hits.suffixes_of))
        flat, n = np.concatenate(list(hits.suffixes_of.values())), np.array([len(x) for x in hits.suffixes_of.values()])
        sort = np.argsort(leads)
        group = sort[np.searchsorted(leads, hits.window, sorter=sort)]
        upto = np.cumsum(n[group])
        lo = 0
        while lo < len(group):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, "right")))
            g = group[lo:hi]
            row = np.repeat(np.arange(lo, hi), n[g])
            step = np.arange(len(row)) - np.repeat(np.cumsum(n[g]) - n[g], n[g])
            test = flat[np.repeat(np.cumsum(n)[g] - n[g], n[g]) + step]
            before = tests.symbols[tests.starts[test] - 1]  # 0 before an item
            first = (before == 0) | (before != hits.symbols[hits.at[row] - 1])
            row, test = row[first], test[first]
            _, agree = compare(tests.symbols, tests.starts[test], hits.symbols, hits.at[row], np.full(len(row), tests.longest))
            word.append(hits.places[row])
            suffix.append(test)
            size.append(agree)
            lo = hi
    word, suffix, size = map(np.concatenate, (word, suffix, size))
    order = np.lexsort((suffix, word))
    return word[order], suffix[order], size[order]


MATCH = "array<struct<item_id:string,item_word:bigint,doc_word:bigint,n_words:bigint>>"


def describe(hits: Hits, tests: Tests):
    """For each document: covered ranges, item ids, and every item's longest match from each place where one begins."""
    order = np.argsort(hits.places, kind="stable")
    places, window = hits.places[order], hits.window[order]
    at = np.searchsorted(places, hits.rows)
    word, suffix, size = longest_matches(hits, tests)
    match_at = np.searchsorted(word, hits.rows)
    for doc in range(len(hits.rows) - 1):
        base, stop = hits.rows[doc], hits.rows[doc + 1]
        lo, hi = at[doc], at[doc + 1]
        if lo == hi:
            yield int(stop - base), [], [], [], []
            continue
        edge = np.diff(hits.covered[base:stop].astype(np.int8), prepend=0, append=0)
        items = {tests.names[i] for w in np.unique(window[lo:hi]).tolist() for i in tests.item[hits.suffixes_of[w]].tolist()}
        mine = slice(match_at[doc], match_at[doc + 1])
        matches = dict.fromkeys(  # a repeated item has equal matches
            (tests.names[i], o, p, k)
            for i, o, p, k in zip(tests.item[suffix[mine]].tolist(), tests.offset[suffix[mine]].tolist(), (word[mine] - base).tolist(), size[mine].tolist())
        )
        matches = [dict(zip(("item_id", "item_word", "doc_word", "n_words"), m)) for m in matches]
        yield int(stop - base), np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist(), sorted(i for i in items if i is not None), matches


def blocks_of(benchmark: DataFrame, window: int, id_col: str, text_col: str, block_bytes: int) -> Iterator[Tests]:
    """The benchmark in blocks of about ``block_bytes`` of text, one at a time."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).collect()
        yield Tests.build([r.id for r in rows], [r.text for r in rows], window)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", doc_text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: words, words hit, items that occur, and the longest verbatim matches."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_text).alias("th"), F.col(doc_text).alias("text"))
    schema = T._parse_datatype_string(
        f"doc_id {kind}, th long, n_words long, begin array<long>, end array<long>, items array<string>, matches {MATCH}"
    )

    def against(sent) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = Tests(**sent.value)
            for batch in batches:
                for part in slices(batch, 2):
                    found = list(describe(search(part.column(2), tests), tests))
                    columns = [pa.array(c, t) for c, t in zip(zip(*found), KINDS)]
                    yield pa.record_batch([part.column(0), part.column(1), *columns], names=schema.names)

        return rows.mapInArrow(run, schema)

    sc = docs.sparkSession.sparkContext
    blocks = [against(sc.broadcast(vars(t))) for t in blocks_of(benchmark, window, item_id, item_text, block_bytes)]
    if not blocks:
        blocks = [against(sc.broadcast(vars(Tests.build([], [], window))))]
    found = blocks[0]
    if len(blocks) > 1:  # one pass each, so that a task holds one block; their ranges overlap
        for more in blocks[1:]:
            found = found.unionByName(more)
        joined = settle(found, "hits").groupBy("doc_id", "th", "n_words").agg(
            F.flatten(F.collect_list(F.arrays_zip("begin", "end"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.flatten(F.collect_list("matches")).alias("matches"),
            F.expr(f"sequence(1, cast(count(*) / {len(blocks)} as int))").alias("copy"),
        )
        merged = F.aggregate(
            F.array_sort("spans"),
            F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("upto")),
            lambda s, x: F.struct(
                (s.hit + F.greatest(F.lit(0), x.end - F.greatest(x.begin, s.upto))).alias("hit"),
                F.greatest(s.upto, x.end).alias("upto"),
            ),
        ).hit
        found = joined.withColumn("n_hit", merged).withColumn("_c", F.explode("copy")).drop("_c", "copy")
    else:
        zero = F.lit(0).cast("long")
        found = found.withColumn(
            "n_hit", F.aggregate("end", zero, lambda s, x: s + x) - F.aggregate("begin", zero, lambda s, x: s + x)
        )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m.n_words)), F.lit(0).cast("long")).alias("longest"),
        "matches",
    )


KINDS = [
    pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()),
    pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())])),
]


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text holds no window of the benchmark."""
    text = docs.columns.index(doc_text)
    blocks = list(blocks_of(benchmark, window, item_id, item_text, block_bytes))
    for i, block in enumerate(blocks):
        sent = docs.sparkSession.sparkContext.broadcast(vars(block))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            tests = Tests(**sent.value)
            for batch in batches:
                for part in slices(batch, text):
                    hits = search(part.column(text), tests)
                    bad = np.unique(np.searchsorted(hits.rows, hits.places, "right") - 1)
                    keep = np.ones(part.num_rows, bool)
                    keep[bad] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
        if i + 1 < len(blocks):
            docs = settle(docs, "clean")
    return docs


SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
item AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, depth, array_to_string(list_slice(w, p, p + depth - 1), ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 10) AS depth, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
        FROM item WHERE len(w) > 0)),
place AS (
  SELECT doc_id, p, depth, array_to_string(list_slice(w, p, p + depth - 1), ' ') AS s
  FROM (SELECT doc_id, w, depth, unnest(range(1, len(w) - depth + 2)) AS p
        FROM doc, (SELECT DISTINCT depth FROM win) WHERE len(w) >= depth)),
hit AS (SELECT doc_id, p, depth, item_id FROM place JOIN win USING (depth, s)),
covered AS (
  SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + depth)) AS x FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, len(doc.w) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op3_benchmark_decontamination", SQL)
def op3(spark, sf_dir):
    """Windows of the benchmark in every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("matches", "longest")
