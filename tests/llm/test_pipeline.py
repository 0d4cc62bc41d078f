import random

import corpus_pipeline
from test_decontaminate import brute as brute_contamination
from test_secret_scan import HEX
from test_simhash import brute_components, brute_fingerprint
from test_toxicity import corpus

from heliotab.llm import pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables(docs, spark):
    rng = random.Random(9)
    rows, labels = corpus(400)
    rows = [(i, f"{t} {' '.join(rng.choices(rows[0][1].split(), k=4))}", lang) for i, t, lang in rows]
    item = "q w e r t y u i o p a s"
    clean = [(1000, "plain text with no harm " * 9, "aa"), (1001, "plain text with no harm " * 9, "aa"), (1002, None, None), (1003, "", "bb")]
    hit = [(1004, "see " + item + " there " + "tir ba " * 20, "aa")]
    secret = [(1005, f'moba tirsel token = "{HEX}" sel {"moba tir " * 9}', "aa")]
    return {
        "documents": docs(rows + clean + hit + secret),
        "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, item)], "item_id long, text string"),
    }


def test_each_stage_on_what_the_one_before_kept(docs, sf, spark):
    path = sf(**tables(docs, spark))
    df = spark.read.parquet(f"{path}/documents.parquet")
    before = {r.doc_id: r for r in df.collect()}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, df, path)
        rows = out.collect()
        ids = {r.doc_id for r in rows}
        assert len(ids) == len(rows) and ids <= set(before), name
        if name == "toxicity":
            assert 1000 in ids and 1002 in ids and len(ids) < len(before)
        if name == "simhash_near_dedup":
            label = brute_components({i: brute_fingerprint(r.text) for i, r in before.items()})
            assert ids == set(label.values())
        if name == "benchmark_decontamination":
            found = brute_contamination([(i, r.text) for i, r in before.items()], [(1, "q w e r t y u i o p a s")])
            assert ids == {f[0] for f in found if not f[5]} and 1004 not in ids
        if name == "secret_scan":
            assert ids == set(before)
            changed = {r.doc_id for r in rows if r.text != before[r.doc_id].text}
            assert changed == {1005}
        if n + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == COLUMNS
            kept = spark.createDataFrame(rows, df.schema)
            df, before = kept, {r.doc_id: r for r in rows}
        else:
            raw = pieces.piece_bytes(pieces.load())
            assert ids == set(before)
            assert all(pieces.text_of(r.ids, raw) == (before[r.doc_id].text or "") for r in rows)


def test_run_on_empty_documents(docs, sf, spark):
    made = tables(docs, spark)
    path = sf(**made | {"documents": docs([])})
    assert corpus_pipeline.run(spark, path).count() == 0
