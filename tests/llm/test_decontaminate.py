import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from heliotab.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(window, len(v))
            parts = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in parts:
                    hit |= set(range(i, i + n))
                    ids.add(item_id)
        names = sorted(str(i) for i in ids if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def cases(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "Cé", "d1", "中", "e"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 4, 10, 14, 30]) if i else 12)) for i in range(8)] + [(50, "one of-two, three!"), (51, None), (52, "..."), (None, say(12)), (3, say(11))]
    docs = [(i, say(rng.choice([0, 3, 9, 40, 120]))) for i in range(15)]
    docs += [(100, items[0][1].upper()), (101, "x " + items[0][1] + " y " + items[0][1]), (102, None), (103, ""), (104, "ONE of (two) THREE"), (100, "a"), (100, "a"), (None, items[0][1])]
    return docs, items


@pytest.mark.parametrize("seed,block", [(0, 1 << 24), (1, 1 << 24), (2, 60)])
def test_against_brute_force(spark, docs, seed, block):
    rows, items = cases(seed)
    df = docs(rows).withColumn("n_hit", F.lit("clash")).withColumn("items", F.lit(0))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("lang", F.lit("x"))
    found = decontaminate.contamination(df, bench, block_bytes=block).drop("longest", "matches")
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, items)
    clean = decontaminate.remove_contaminated(df, bench, block_bytes=block)
    assert clean.columns == df.columns
    # a document that holds only windows of an item without id goes as well
    stay = [r[0] for r, b in zip(rows, [brute([r], items)[0] for r in rows]) if not b[5]]
    assert sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(map(str, stay))


def test_longest_match_and_its_place(spark, docs):
    item = "q w e r t y u i o p a s d f"
    df = docs([(1, "start " + item + " end"), (2, "w e r t y u i o p a z")])
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: [tuple(m) for m in r.matches] for r in decontaminate.contamination(df, bench).collect()}
    assert got == {1: [("7", 0, 1, 14)], 2: [("7", 1, 0, 10)]}


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(4)
    symbols = np.concatenate((rng.integers(0, 4, 3000), np.zeros(80, int)))
    at = np.flatnonzero(symbols[:3000])
    order = decontaminate.suffix_array(symbols, at, 3, 64)
    suffix = lambda p: tuple(symbols[p : p + int(np.argmax(symbols[p:] == 0))])
    assert sorted(order) == sorted(at)
    assert [suffix(p) for p in order] == sorted(suffix(p) for p in at)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in decontaminate.contamination(docs([(1, "a b")]), none).collect()] == [False]
    assert decontaminate.remove_contaminated(docs([(1, "a b")]), none).count() == 1
    assert decontaminate.contamination(docs([]), none).count() == 0


def test_words_of_a_column_with_nulls():
    hashes, rows = decontaminate.words_of(pa.array(["A b", None, "", "b a"]))
    assert rows.tolist() == [0, 2, 2, 2, 4] and hashes[0] == hashes[3] and hashes[1] == hashes[2]


def brute_matches(docs, items, window=10):
    """(doc, item, its word, document's word, words) of all matches of a window at least that cannot be extended."""
    out = set()
    for doc_id, text in docs:
        w = words(text)
        for item_id, item in items:
            v = words(item)
            for o in range(len(v)):
                for p in range(len(w)):
                    if o and p and v[o - 1] == w[p - 1]:
                        continue
                    k = 0
                    while o + k < len(v) and p + k < len(w) and v[o + k] == w[p + k]:
                        k += 1
                    if k >= min(window, len(v)):
                        out.add((doc_id, None if item_id is None else str(item_id), o, p, k))
    return out


@pytest.mark.parametrize("pairs", [1 << 18, 7])
def test_every_item_has_its_longest_matches(spark, docs, monkeypatch, pairs):
    """Items that share a beginning, an item under two ids, and a repeated item."""
    say = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    a, b = say("p", 50) + " " + say("a", 50), say("p", 50) + " " + say("b", 50)
    bench = spark.createDataFrame([(1, a), (2, b), (3, b), (3, b)], "item_id long, text string")
    (row,) = decontaminate.contamination(docs([(9, "x " + b + " y")]), bench).collect()
    assert sorted(tuple(m) for m in row.matches) == [("1", 0, 1, 50), ("2", 0, 1, 100), ("3", 0, 1, 100)]
    assert row.longest == 100
    for seed in (0, 1):
        rows, items = cases(seed)
        texts = [t for _, t in rows]
        column = pa.array(texts, pa.string())
        monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        tests = decontaminate.Tests.build([None if i is None else str(i) for i, t in items if t], [t for _, t in items if t], 10)
        got = [(d, *m.values()) for d, x in enumerate(decontaminate.describe(decontaminate.search(column, tests), tests)) for m in x[4]]
        assert len(got) == len(set(got)) and set(got) == brute_matches(list(enumerate(texts)), items)
