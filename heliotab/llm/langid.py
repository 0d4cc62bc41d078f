"""Language identification with bit-sliced Bloom filters over n-grams of UTF-8 bytes.

One table of slots serves all languages: a slot holds a bitmask of the languages that put an n-gram
there. The masks of an n-gram's slots, ANDed, give all languages that contain it at once. Per language
the hits of a text are counted, the expected false positives are taken off, and the largest count
decides.

The filters are fitted on a sample of about ``PER_LANGUAGE`` documents of each language, chosen by a
hash of the id. An n-gram enters the filter of each language in which it is at least ``SHARE`` as common
as where it is most common, so stray words do not blur the filters.

Defined results: a text that is null or has no letter is ``und`` with score 0; a text without a known
n-gram gets the most frequent language of the sample; ties go to the first language by name; without
labelled rows everything is ``und``; repeated rows each give a row; other columns are not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .registry import query, table
from .textbytes import LOWER, byte_table, mix, slices, text_bytes

SIZES = (3, 5)  # bytes of an n-gram, word ends included
HASHES = 3
SLOT_BITS = 21
PER_LANGUAGE = 2_000
SHARE = 0.25
LEAST_DOCS = 2  # learning documents that an n-gram must occur in
FEW_DOCS = 50  # a language with fewer learning documents keeps the n-grams of a single one
WAITING = 1 << 19  # n-grams of documents that are counted together in a task
TOGETHER = 1 << 18  # bytes of text whose n-grams are looked up together
LETTERS = byte_table([*range(0x61, 0x7B), *range(0x80, 0x100)])
SPACE = 0x20


def spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of all rows, everything else blank, each row between two blanks."""
    data, at = text_bytes(column)
    data = LOWER[data]
    size = np.diff(at)
    out = np.full(len(data) + 2 * len(size), SPACE, np.uint8)
    shift = np.repeat(1 + 2 * np.arange(len(size), dtype=np.int64), size)
    out[np.arange(len(data)) + shift] = np.where(LETTERS[data], data, SPACE)
    return out, at + 2 * np.arange(len(at))


def grams(chars: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n-gram at each place, and whether it counts: no two blanks in a row."""
    n = max(0, len(chars) - size + 1)
    key = np.full(n, size << 56, np.uint64)
    for j in range(size):
        key |= chars[j : j + n].astype(np.uint64) << np.uint64(8 * j)
    blank = chars == SPACE
    double = blank[1:] & blank[:-1]
    good = np.ones(n, bool)
    for j in range(size - 1):
        good &= ~double[j : j + n]
    return mix(key), good


@dataclass
class Filters:
    languages: list  # by name; bit l of a mask is language l
    masks: list  # arrays of 2**SLOT_BITS slots, one for each 64 languages
    false: list  # chance that a strange n-gram passes, by language
    default: int

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Corrected hits by row and language, and the n-grams of each row."""
        chars, at = spaced(column)
        rows = len(at) - 1
        hits, total = np.zeros((rows, len(self.languages))), np.zeros(rows)
        if not rows:
            return hits, total
        low = np.uint64((1 << SLOT_BITS) - 1)
        for size in SIZES:
            key, good = grams(chars, size)
            pad = len(chars) - len(key)
            good = np.concatenate((good, np.zeros(pad, bool)))
            total += np.add.reduceat(good, at[:-1], dtype=np.int64)
            slots = [((key >> np.uint64(SLOT_BITS * k)) & low).astype(np.int64) for k in range(HASHES)]
            for w, masks in enumerate(self.masks):
                found = masks[slots[0]]
                for s in slots[1:]:
                    found &= masks[s]
                found = np.concatenate((found, np.zeros(pad, found.dtype))) * good
                for b in range(min(64, len(self.languages) - 64 * w)):
                    one = (found >> found.dtype.type(b)) & found.dtype.type(1)
                    hits[:, 64 * w + b] += np.add.reduceat(one, at[:-1], dtype=np.int64)
        false = np.array(self.false)
        return np.maximum(0.0, (hits - total[:, None] * false) / (1 - false)), total

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language number and its share of the corrected hits, for each row."""
        hits, _ = self.counts(column)
        best, sums = hits.argmax(axis=1), hits.sum(axis=1)
        best[sums == 0] = self.default
        score = hits.max(axis=1, initial=0) / np.maximum(sums, 1e-300)
        return best, np.where(sums > 0, score, 1 / len(self.languages))


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int | None = PER_LANGUAGE
) -> Filters | None:
    """Filters from rows with a language; None if there are none. Without ``per_language`` all rows are counted.

    An n-gram must be as common among all rows as ``LEAST_DOCS`` of a sample are, so the filters do not fill up.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter("lang is not null and text is not null")
    sizes = settle(rows.groupBy("lang").count(), "languages")
    per = sizes.orderBy("lang").collect()
    if not per:
        return None
    number = {r.lang: i for i, r in enumerate(per)}
    # The table of languages is written, so Spark sees its size and broadcasts it while it is small.
    sample = rows.join(sizes, "lang").filter(F.pmod(F.xxhash64("id", "text"), "count") < per_language) if per_language else rows
    sample = sample.select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # arrays of n-grams and their documents, by language
        waiting = 0

        def merged():
            for lang, got in held.items():
                key = np.concatenate([g for g, _ in got])
                seen, place = np.unique(key, return_inverse=True)
                docs = np.bincount(place, np.concatenate([d for _, d in got]), len(seen)).astype(np.int64)
                yield lang, seen, docs

        def out():
            for lang, seen, docs in merged():
                yield pa.record_batch(
                    [pa.array(np.full(len(seen), lang, np.int32)), pa.array(seen.view(np.int64)), pa.array(docs)],
                    names=["lang", "gram", "docs"],
                )
            held.clear()

        for batch in batches:
            for part in slices(batch, 1, TOGETHER):
                chars, at = spaced(part.column(1))
                langs = [number[x] for x in part.column(0).to_pylist()]
                for size in SIZES:
                    key, good = grams(chars, size)
                    for i in range(part.num_rows):
                        mine = np.unique(key[at[i] : at[i + 1]][good[at[i] : at[i + 1]]])
                        held.setdefault(langs[i], []).append((mine, np.ones(len(mine))))
                        waiting += len(mine)
                if waiting > WAITING:
                    for lang, seen, docs in list(merged()):
                        held[lang] = [(seen, docs)]
                    waiting = sum(len(g) for got in held.values() for g, _ in got)
                    if waiting > WAITING // 2:
                        yield from out()
                        waiting = 0
        yield from out()

    seen = sample.mapInArrow(count, "lang int, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    kept = {i: min(r["count"], per_language or r["count"]) for i, r in enumerate(per)}
    learnt = F.get(F.array(*[F.lit(float(kept[i])) for i in range(len(per))]), F.col("lang"))
    rate, needed = F.col("docs") / learnt, F.when(learnt < FEW_DOCS, 1).otherwise(F.greatest(F.lit(float(LEAST_DOCS)), learnt * (LEAST_DOCS / (per_language or PER_LANGUAGE))))
    by_gram = (
        seen.filter(F.col("docs") >= needed).withColumn("rate", rate)
        .groupBy("gram").agg(F.max("rate").alias("most"), F.collect_list(F.struct("lang", "rate")).alias("of"))
    )
    slot = F.explode(F.array(*[F.shiftrightunsigned("gram", SLOT_BITS * k).bitwiseAND(F.lit((1 << SLOT_BITS) - 1)) for k in range(HASHES)]))
    bits = (
        by_gram.select("gram", "most", F.explode("of").alias("x")).filter(F.col("x.rate") >= SHARE * F.col("most"))
        .select(slot.alias("slot"), F.floor(F.col("x.lang") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, x.lang % 64)").alias("bit"))
        .groupBy("word", "slot").agg(F.bit_or("bit").alias("mask"))
    )
    # At most 2**SLOT_BITS rows for each 64 languages, however large the corpus.
    got = bits.toArrow()
    width = np.uint64 if len(per) > 32 else np.uint32 if len(per) > 16 else np.uint16 if len(per) > 8 else np.uint8
    masks = [np.zeros(1 << SLOT_BITS, width) for _ in range(-(-len(per) // 64))]
    word, at, mask = (got.column(c).to_numpy() for c in ("word", "slot", "mask"))
    for w, m in enumerate(masks):
        m[at[word == w]] = mask[word == w].view(np.uint64).astype(width)
    false = [float(((masks[i // 64] >> width(i % 64)) & width(1)).mean() ** HASHES) for i in range(len(per))]
    default = max(range(len(per)), key=lambda i: (per[i]["count"], -i))
    return Filters([r.lang for r in per], masks, false, default)


def identify(docs: DataFrame, filters: Filters | None, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with lang_pred and score."""
    rest = [c for c in docs.columns if c != text_col]
    text = F.col(text_col)
    if filters is None:
        return docs.select(*rest, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(vars(filters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Filters(**sent.value)
        names = np.array(model.languages, object)
        for batch in batches:
            for part in slices(batch, 0, TOGETHER):
                best, score = model.predict(part.column(0))
                lettered = part.column(1).to_numpy(zero_copy_only=False)
                columns = [pa.array(np.where(lettered, names[best], "und"), pa.string()), pa.array(np.where(lettered, score, 0.0))]
                yield pa.record_batch([*part.columns[2:], *columns], names=[*rest, "lang_pred", "score"])

    schema = docs.select(*rest, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    ready = docs.select(text.alias("_text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_letters"), *rest)
    return ready.mapInArrow(run, schema)


@query("op5_language_id")
def op5(spark, sf_dir):
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    filters = fit(docs.filter(part != 2))
    return identify(docs.select("doc_id", "text", F.coalesce(part == 2, F.lit(False)).alias("held_out")), filters)
