import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from heliotab.llm import langid
from heliotab.llm.registry import QUERIES

SYLLABLES = {"aa": ["ba", "mo", "tir", "sel"], "bb": ["ух", "жа", "лен", "ко"], "cc": ["zsch", "ung", "ö", "keit"]}


def say(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(n=90, seed=1):
    rng = random.Random(seed)
    return [(i, say(rng, lang := rng.choice(list(SYLLABLES)), rng.choice([2, 5, 40])), lang) for i in range(n)]


def test_accuracy_and_defined_results(docs, sf, spark):
    rows = corpus() + [(900, None, "aa"), (901, "", "bb"), (902, "12 +-", "cc"), (903, "漢字", None), (903, "漢字", None), (None, "ba mo tir", "aa")]
    path = sf(documents=docs(rows).withColumn("score", F.lit(1)))
    got = QUERIES["op5_language_id"](spark, path)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    out = got.collect()
    assert len(out) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in out if r.held_out and r.doc_id < 900]
    assert held and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert {r.lang_pred for r in out if r.doc_id in (900, 901, 902)} == {"und"}
    assert all(0 <= r.score <= 1 for r in out)
    assert len([r for r in out if r.doc_id == 903 and r.lang_pred in SYLLABLES]) == 2


def test_predictions_do_not_see_language_source_or_id(docs, spark):
    rows = corpus()
    filters = langid.fit(docs(rows))
    a = {r.text_no: (r.lang_pred, r.score) for r in langid.identify(docs(rows).withColumn("text_no", F.xxhash64("text")), filters).collect()}
    other = [(5000 + i, t, "aa") for i, t, _ in rows]
    b = {r.text_no: (r.lang_pred, r.score) for r in langid.identify(docs(other, 1).withColumn("text_no", F.xxhash64("text")), filters).collect()}
    assert a == b


def test_without_labels_or_rows(docs):
    assert langid.fit(docs([(1, "abc", None)])) is None
    assert [r.lang_pred for r in langid.identify(docs([(1, "abc")]), None).collect()] == ["und"]
    assert langid.identify(docs([]), langid.fit(docs(corpus()))).count() == 0


def test_counts_are_those_of_plain_sets():
    """Against sets of n-grams: with the false positives taken off, hits are nearly exact."""
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(60)]
    known = [set(), set()]
    masks = np.zeros(1 << langid.SLOT_BITS, np.uint8)
    low = np.uint64((1 << langid.SLOT_BITS) - 1)
    for lang, part in enumerate((words[:40], words[20:])):
        for size in langid.SIZES:
            key, good = langid.grams(langid.spaced(pa.array([" ".join(part)]))[0], size)
            known[lang] |= set(key[good].tolist())
            for k in range(langid.HASHES):
                masks[((key[good] >> np.uint64(langid.SLOT_BITS * k)) & low).astype(int)] |= 1 << lang
    text = " ".join(words)
    filters = langid.Filters(["x", "y"], [masks], [0.0, 0.0], 0)
    hits, total = filters.counts(pa.array([text, None, ""]))
    expected = [0, 0]
    n = 0
    for size in langid.SIZES:
        key, good = langid.grams(langid.spaced(pa.array([text]))[0], size)
        n += good.sum()
        for lang in (0, 1):
            expected[lang] += sum(int(k) in known[lang] for k in key[good])
    assert total.tolist() == [n, 0, 0] and hits[0].tolist() == expected


def test_a_language_with_one_learning_document_keeps_its_ngrams(docs):
    rng = random.Random(4)
    rows = [(i, say(rng, "aa", 30), "aa") for i in range(120)] + [(500, say(rng, "bb", 60), "bb")]
    filters = langid.fit(docs(rows))
    got = langid.identify(docs([(1, say(rng, "bb", 20)), (2, say(rng, "aa", 20))]), filters).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "bb", 2: "aa"}
