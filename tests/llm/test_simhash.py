import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from heliotab.llm import simhash
from heliotab.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    ids, label = sorted(prints), {}
    for i in ids:
        if i in label:
            continue
        label[i], todo = i, [i]
        while todo:
            a = todo.pop()
            for b in ids:
                if b not in label and (prints[a] ^ prints[b]).bit_count() <= 2:
                    label[b] = i
                    todo.append(b)
    return label


TEXTS = ["a b c d e f", "A b C d e f", "a b", "ab", "", None, " \t\n", "x " * 5000, "é É ß\x0bq", "a b c d", "one two three", "one two three"]


def test_fingerprints(docs):
    rows = {r.doc_id: r.fp % 2**64 for r in simhash.fingerprints(docs(list(enumerate(TEXTS)))).collect()}
    assert rows == {i: brute_fingerprint(t) for i, t in enumerate(TEXTS)}


def test_word_blocks_do_not_cut_shingles():
    text = " ".join(random.Random(1).choice(["lorem", "ipsum", "dolor", "x"]) for _ in range(400_000))
    assert len(text) > 1 << 20
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("tile", [7, 20_000])
def test_links_connect_what_brute_force_connects(spark, tile):
    rng = random.Random(3)
    prints = {0, 2**64 - 1}
    for _ in range(25):
        seed = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):  # chains and stars
            prints.add(seed)
            seed ^= 1 << rng.randrange(64)
    prints = {i: p for i, p in enumerate(sorted(prints))}
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints.values()]
    points = spark.createDataFrame(signed, "fp long")
    labels = {r.vertex: r.label for r in components(simhash.links(points, tile=tile)).collect()}
    brute = brute_components(prints)
    by_print = {int(np.uint64(p).astype(np.int64)): brute[i] for i, p in prints.items()}
    groups = {}
    for p, c in by_print.items():
        groups.setdefault(c, set()).add(labels.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.vertex: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


def test_components_and_the_row_that_stays(docs):
    rows = [(5, "p q r s t"), (3, "P q r s t"), (3, "P q r s t"), (9, None), (8, ""), (None, "p q r s t"), (None, "alone here now"), (2, "z y x w v")]
    df = docs(rows).withColumns({c: F.lit("x") for c in ("fp", "component_id", "th", "_id", "_n", "label")})
    found = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(df).collect())
    want = [("5", 3), ("3", 3), ("3", 3), ("9", 8), ("8", 8), ("None", 3), ("None", None), ("2", 2)]
    assert found == sorted((i, str(c)) for i, c in want)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "8", "None"]


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.keep_one(docs([])).count() == 0
