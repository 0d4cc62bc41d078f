import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.llm import repeats
from heliotab.llm.registry import QUERIES


def brute(rows, width=35):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = {}
    for w in split:
        for i in range(len(w) - width + 1):
            k = tuple(w[i : i + width])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = {i + j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(width)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(doc_id), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    say = lambda n: [rng.choice("abcdefgh") + rng.choice("xyzé") for _ in range(n)]
    passage, line = say(60), say(36)
    rows = [(i, " ".join(say(rng.choice([0, 10, 34, 35, 90, 300])))) for i in range(12)]
    rows += [(20 + i, "\n".join(say(5) + passage[i : i + 50] + say(rng.randint(0, 20)))) for i in range(8)]
    rows += [(40, " ".join(line + line)), (41, " ".join(["la"] * 90)), (42, " ".join(["lo"] * 35)), (43, " ".join(["li"] * 36))]
    rows += [(50, None), (51, ""), (52, " \t"), (20, rows[12][1]), (20, rows[12][1]), (60, rows[3][1]), (None, " ".join(passage)), (None, "short one")]
    return rows


@pytest.mark.parametrize("seed,sample", [(1, 4000), (2, 0), (3, 12)])
def test_against_brute_force(docs, sf, spark, monkeypatch, seed, sample):
    """With the frequent windows known, with none known, and with some."""
    monkeypatch.setattr(repeats, "SAMPLE_DOCS", sample)
    monkeypatch.setattr(repeats, "FREQUENT", 2)
    rows = corpus(seed)
    path = sf(documents=docs(rows).withColumn("begin", F.lit("x")).withColumn("th", F.lit("y")))
    out = QUERIES["op6_substring_dedup"](spark, path).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in out) == brute(rows)


def test_pieces_of_a_long_text_miss_no_window(docs, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 64)
    rng = random.Random(8)
    words = [rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(700)]
    rows = [(1, " ".join(words)), (2, " ".join(words[100:300])), (3, " ".join(words[555:640]))]
    out = repeats.without_repeats(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in out) == brute(rows)


def test_sliding_least():
    values = np.random.default_rng(1).integers(0, 99, 200).astype(np.uint64)
    for width in (1, 2, 3, 8, 30):
        assert repeats.sliding_least(values, width).tolist() == [values[i : i + width].min() for i in range(200 - width + 1)]


def test_empty_table(docs):
    assert repeats.without_repeats(docs([])).count() == 0


@pytest.mark.parametrize("sample", [0, 4000])
def test_a_factor_occurs_at_its_source_as_one_passage(docs, monkeypatch, sample):
    """Windows 0 to 25 of the first text lie in the second, 25 to 65 in the third: no factor may span both."""
    monkeypatch.setattr(repeats, "SAMPLE_DOCS", sample)
    monkeypatch.setattr(repeats, "FREQUENT", 2)
    w = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:60])), (3, " ".join(w[25:]))] + corpus(5)
    df = docs(rows).withColumn("h", F.xxhash64("text"))
    text = {r.h: (r.text or "").split() for r in df.collect()}
    found = repeats.factors(df).collect()
    for r in found:
        size = r.n + repeats.WINDOW - 1
        assert text[r.th][r.begin : r.begin + size] == text[r.of_th][r.of_begin : r.of_begin + size]
        assert len(text[r.of_th]) >= r.of_begin + size
    assert {r.begin + i for r in found if r.doc_id == 1 for i in range(r.n)} >= set(range(66))


def test_factors_are_greedy_and_longest():
    symbols = np.array([1, 2, 3, 4, 1, 2, 3, 4, 1, 2])
    new = np.isin(np.arange(10), [0, 4, 6, 8])  # 1234, 12, 34, 12
    first, n, source = repeats.greedy(symbols - 1, new)
    got = sorted(zip(first.tolist(), n.tolist()))
    assert got == [(0, 2), (2, 2), (4, 2), (6, 2), (8, 2)]
    assert all(f != s and symbols[f : f + k].tolist() == symbols[s : s + k].tolist() for f, k, s in zip(first, n, source))


@pytest.mark.parametrize("seed", range(6))
def test_greedy_parse_against_brute_force(seed):
    """Symbols that occur once are literals; every factor is the longest match from its place."""
    rng = np.random.default_rng(seed)
    symbols = rng.integers(0, [3, 12, 40, 200, 10**6, 2][seed], 150)
    symbols = np.unique(symbols, return_inverse=True)[1]
    new = rng.random(150) < 0.15
    new[0] = True
    ends = np.append(np.flatnonzero(new)[1:], 150)
    end_of = ends[np.cumsum(new) - 1]

    def match(i):
        best = 0
        for j in range(150):
            k = 0
            while j != i and i + k < end_of[i] and j + k < end_of[j] and symbols[i + k] == symbols[j + k]:
                k += 1
            best = max(best, k)
        return best

    expected, i = [], 0
    while i < 150:
        n = match(i)
        if n:
            expected.append((i, n))
        i += max(n, 1)
    first, n, source = repeats.greedy(symbols, new)
    assert sorted(zip(first.tolist(), n.tolist())) == expected
    assert all(symbols[f : f + k].tolist() == symbols[s : s + k].tolist() and f != s for f, k, s in zip(first, n, source))


def test_an_index_without_matches_removes_nothing(monkeypatch):
    """What goes is decided by the longest matches of the index alone."""
    symbols, new = np.array([0, 1, 2, 0, 1, 2]), np.array([True, False, False, True, False, False])
    assert len(repeats.greedy(symbols, new)[0]) == 2
    monkeypatch.setattr(repeats, "compare", lambda a, x, b, y, depth: (None, np.zeros(len(x), np.int64)))
    assert len(repeats.greedy(symbols, new)[0]) == 0


def line_in_many(n):
    """A line shorter than a window in n documents, the words around it new in each, and some copies."""
    line = " ".join(f"l{i}" for i in range(30))
    new = lambda i: " ".join(f"{i}x{j}" for j in range(20))
    return [(i, f"{new(i)} {line} {new(-i - 1)}") for i in range(n)] + [(i, f"{new(i)} {line} {new(-i - 1)}") for i in range(0, n, 7)]


def test_the_windows_of_a_common_short_line_are_dealt_out(docs, monkeypatch):
    """None of them is frequent, and all have the line's anchor."""
    monkeypatch.setattr(repeats, "CROWDED", 64)
    rows = line_in_many(150)
    df = docs(rows).select("doc_id", F.xxhash64("text").alias("th"), "text")
    largest = repeats.parts(df).filter("n = 0").groupBy("anchor").agg(F.sum(F.length("symbols") / repeats.SYMBOL).alias("n"))
    assert largest.agg(F.max("n")).first()[0] < 3 * 64
    out = repeats.without_repeats(docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in out) == brute(rows)
