import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from heliotab.llm import textbytes, toxicity
from heliotab.llm.registry import QUERIES

PLAIN = {"aa": ["ba", "mo", "tir", "sel"], "bb": ["ux", "ja", "len", "ko"]}
BAD = {"aa": ["scumm", "vilest"], "bb": ["lowejko", "lowejux", "lowejlen"]}


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        lang = rng.choice(list(PLAIN))
        words = ["".join(rng.choice(PLAIN[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.choice([5, 30, 150]))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(BAD[lang]))
        docs.append((i, " ".join(words), lang))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_defined_results(docs, sf, spark):
    rows, labels = corpus()
    more = [(9000, None, "aa"), (9001, "", None), (9002, "...", "bb"), (9002, "...", "bb"), (None, "ba mo", "aa")]
    lab = spark.createDataFrame([*labels, (0, 1, labels[0][2]), (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    path = sf(documents=docs(rows + more).withColumn("predicted", F.lit("x")), labels=lab)
    got = QUERIES["op7_toxicity"](spark, path)
    assert [t for _, t in got.dtypes] == ["bigint", "boolean", "double", "int"]
    out = got.collect()
    assert len(out) == len(rows) + len(more)
    truth = {i: t for i, _, t in labels}
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    assert not any(r.predicted for r in out if r.doc_id in (9000, 9001, 9002))


def test_labels_of_the_held_out_fold_change_nothing(docs, spark):
    rows, labels = corpus(200)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    schema = "doc_id long, quality int, toxic int"
    a = toxicity.train_on_folds(docs(rows), spark.createDataFrame(labels, schema))
    flipped = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    b = toxicity.train_on_folds(docs(rows, 1), spark.createDataFrame(flipped, schema))
    column = pa.array([t for _, t, _ in rows])
    assert np.allclose(toxicity.scorer(a)(column), toxicity.scorer(b)(column))


def test_one_class_or_no_labels(docs, spark):
    rows, _ = corpus(5)
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(i, 1, 0) for i in range(5)]):
        model = toxicity.train(docs(rows), spark.createDataFrame(labels, schema))
        assert toxicity.with_scores(docs(rows), model).filter("score >= 0.5").count() == 0
    assert toxicity.remove_toxic(docs([]), model).count() == 0


def test_blocks_of_words_do_not_change_maxima(monkeypatch):
    rng = np.random.default_rng(1)
    net = toxicity.Net.start(rng)
    size = [0, 1, 2, 700, 0, 3, 40]
    rows = np.concatenate(([0], np.cumsum(size)))
    buckets = rng.integers(0, 1 << toxicity.BUCKET_BITS, (rows[-1], 4)).astype(np.int32)
    whole = net.pooled(buckets, rows)[0]
    monkeypatch.setattr(toxicity, "BLOCK", 13)
    assert np.allclose(whole, net.pooled(buckets, rows)[0], atol=1e-6)
    # and against one document and one window at a time
    for d, (a, b) in enumerate(zip(rows[:-1], rows[1:])):
        v = net.emb[buckets[a:b]].sum(axis=1)
        for f, (w, weights) in enumerate(zip(toxicity.WIDTHS, net.filters)):
            best = np.zeros(toxicity.FILTERS)
            for i in range(b - a):
                r = sum(v[i + j] @ weights[j] for j in range(w) if i + j < b - a) + net.bias[f * toxicity.FILTERS : (f + 1) * toxicity.FILTERS]
                best = np.maximum(best, r)
            assert np.allclose(best, whole[d, f * toxicity.FILTERS : (f + 1) * toxicity.FILTERS], atol=1e-5)


def test_gradients_lower_the_loss():
    rows, labels = corpus(120)
    buckets, at = toxicity.features(pa.array([t for _, t, _ in rows]))
    y = np.array([t for _, _, t in labels], float)
    z = toxicity.train_net(buckets, at, y, epochs=4).logits(buckets, at)
    assert ((z > 0) == y).mean() > 0.95


def test_threshold_is_in_the_widest_gap():
    assert toxicity.threshold(np.array([0.0, 1.0, 5.0, 6.0]), np.array([0, 0, 1, 1.0])) == 3.0


def test_repeated_rows_do_not_swell_the_sample(docs, spark):
    """Hundreds of copies of one labelled row are learned from once."""
    rows, labels = corpus(150)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    once = toxicity.train(docs(rows), lab)
    more = toxicity.train(docs(rows + [rows[0]] * 400, 3), lab)
    assert np.array_equal(once["net"]["emb"], more["net"]["emb"])


def test_training_improves_on_its_start():
    """Two words are toxic side by side only: the start cannot tell, the trained filters can."""
    rng = random.Random(5)
    texts, y = [], []
    for i in range(900):
        words = ["".join(rng.choice(PLAIN["aa"]) for _ in range(3)) for _ in range(20)]
        at = rng.randrange(18)
        words[at : at + 2] = ["mox", "rul"] if i % 3 == 0 else ["rul", "mox"]
        texts.append(" ".join(words))
        y.append(float(i % 3 == 0))
    buckets, rows = toxicity.features(pa.array(texts))
    y, cut = np.array(y), 600
    share = {}
    for epochs in (0, 12):
        net = toxicity.train_net(buckets[: rows[cut]], rows[: cut + 1], y[:cut], epochs)
        z = net.logits(buckets, rows)
        share[epochs] = ((z >= toxicity.threshold(z[:cut], y[:cut])) == y)[cut:].mean()
    assert share[0] < 0.75 and share[12] > 0.95


def test_every_labelled_row_is_learned_from(docs, spark, monkeypatch):
    """Thousands of rows of one class and a text of more than 64 KB reach the filters, the net and the thresholds."""
    rows, labels = corpus(300)
    rows += [(1000 + i, f"ba mo {i}", "aa") for i in range(4000)] + [(9000, "ux ja " * 12_000, "bb")]
    labels += [(i, 1, 0) for i, *_ in rows[300:]]
    seen = {}

    def spy(name, arg=0):
        inner = getattr(toxicity, name)

        def run(*args, **kwargs):
            seen[name] = args[arg].select("text").distinct().count()
            return inner(*args, **kwargs)

        monkeypatch.setattr(toxicity, name, run)

    for name in ("fit_languages", "start_net", "trained_net", "margins"):
        spy(name)
    model = toxicity.train(docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), shard_rows=500)
    assert seen["fit_languages"] == len({t for _, t, _ in rows})
    assert seen["start_net"] == seen["trained_net"] and seen["trained_net"] + seen["margins"] == seen["fit_languages"]
    score = toxicity.scorer(model)(pa.array([t for _, t, _ in rows]))
    assert np.mean((score >= 0.5) == np.array([t for *_, t in labels])) > 0.98


def test_start_counts_all_rows(docs, spark):
    rows, labels = corpus(200)
    learned = docs(rows, 5).join(spark.createDataFrame(labels, "doc_id long, quality int, y int"), "doc_id")
    buckets, at = toxicity.features(pa.array([t for _, t, _ in rows]))
    y = np.array([t for *_, t in labels], float)
    whole = toxicity.started(toxicity.bucket_counts(buckets, at, y), 0.25)
    assert np.array_equal(whole.emb, toxicity.start_net(learned, 0.25).emb)


def test_thresholds_of_all_rows_equal_those_in_memory(spark):
    rng = np.random.default_rng(2)
    z, y, lang = rng.normal(size=700).round(2), rng.integers(0, 2, 700), rng.integers(0, 3, 700)
    z += y * lang  # apart, a little, not at all
    z[lang == 2] += 9.0 * y[lang == 2]
    y[lang == 0] = 0
    rows = [(int(a), float(b), int(c)) for a, b, c in zip(lang, z, y)]
    got = toxicity.thresholds(spark.createDataFrame(rows, "lang int, z double, y int").repartition(3))
    for k in range(3):
        mine = lang == k
        want = (toxicity.threshold(z[mine], y[mine]), max(0, y[mine].sum()), (1 - y[mine]).sum())
        assert np.allclose(got[k], want)


def test_memory_of_a_worker_is_bounded_by_blocks():
    buckets = np.random.default_rng(2).integers(0, 1 << 16, (2_000_000, 4)).astype(np.uint16)
    tracemalloc.start()
    try:
        held = toxicity.occurrences(buckets)
        assert tracemalloc.get_traced_memory()[1] < 16 << 20
        textbytes._POWERS.clear()
        tracemalloc.reset_peak()
        data = np.full(3_000_000, 0x61, np.uint8)
        found = textbytes.span_hashes(data, np.arange(0, 2_999_990, 10), np.arange(7, 2_999_997, 10))
        assert tracemalloc.get_traced_memory()[1] < 48 << 20 and len(set(found.tolist())) == 1
        assert sum(x.nbytes for pair in textbytes._POWERS.values() for x in pair) <= 8 << 20
    finally:
        tracemalloc.stop()
    assert held.sum() == buckets.size and held[buckets[0, 0]] == (buckets == buckets[0, 0]).sum()
