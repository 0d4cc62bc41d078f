import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.llm import pieces


@pytest.fixture(scope="module")
def loaded():
    return pieces.load()


def ids(lattice, text):
    return np.frombuffer(lattice.encode(text), np.int32).tolist()


def chunked(lattice, text, chunk):
    reach = lattice.longest
    parts = [(text[i : i + chunk + reach], len(text[i : i + chunk])) for i in range(0, len(text), chunk)]
    leads = lattice.leads(parts)
    starts = pieces.scan(np.stack([np.frombuffer(x["matrix"]).reshape(reach, reach) for x in leads]))
    traces = [lattice.trace(x["lead"], x["upto"], x["cut"], v) for x, v in zip(leads, starts)]
    out, state = [], 0
    for x, t in reversed(list(zip(leads, traces))):
        out = (t["paths"][0] + list(x["middle"]) + x["rests"][state] if x["cut"] else t["paths"][state]) + out
        state = t["entries"][state]
    return out


def best_sum(lattice, text):
    """Plain dynamic programming over the whole text."""
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + lattice.longest) + 1):
            found = lattice.pieces.get(text[i:j])
            score = found[1] if found else lattice.unknown if j == i + 1 else None
            if score is not None:
                best[j] = max(best[j], best[i] + score)
    return best[-1]


WORDS = ["the", "an", "▁", " ", "  ", "日本", "é", "\n", "zzz", "ing", "\U0001f600", "1234", "abc日é\n"]


@pytest.mark.parametrize("cuts", [True, False])
def test_chunks_give_the_same_path(loaded, cuts):
    rng = random.Random(5)
    lattice = pieces.Lattice(**loaded)
    assert lattice.cuts
    lattice.cuts = cuts
    for _ in range(60 if cuts else 15):
        text = ("▁" + "".join(rng.choice(WORDS) for _ in range(rng.randint(1, 80)))).replace(" ", "▁")
        whole = ids(pieces.Lattice(**loaded) if cuts else lattice, text)
        assert chunked(lattice, text, rng.choice([16, 20, 33])) == whole
        assert lattice.worth[whole].sum() == best_sum(lattice, text)
        assert pieces.text_of(whole, pieces.piece_bytes(loaded)) == text.replace("▁", " ")[1:]


def test_matrices_combine_associatively(loaded):
    lattice = pieces.Lattice(**loaded)
    lattice.cuts = False
    text = "▁" + "thequickbrownfoxandtheother" * 3
    n = lattice.longest
    a, b, c = (np.frombuffer(lattice.lead(text[i : i + 20 + n], 20, 20, 20, b"")["matrix"]).reshape(n, n) for i in (0, 20, 40))
    left, right = pieces.combine(pieces.combine(a, b), c), pieces.combine(a, pieces.combine(b, c))
    assert (left == right).all()
    joined = np.frombuffer(lattice.lead(text[: 60 + n], 60, 60, 60, b"")["matrix"]).reshape(n, n)
    assert joined[0].tolist() == left[0].tolist()


def test_best_paths_are_those_of_the_library(loaded):
    """The same vocabulary read as a unigram model; its n-best list begins with the best path."""
    import sentencepiece

    raw = open(pieces.MODEL, "rb").read()
    at = raw.index(b"\x18\x02", len(raw) - 2000)  # the model type in the trainer's settings
    model = sentencepiece.SentencePieceProcessor()
    model.LoadFromSerializedProto(raw[:at] + b"\x18\x01" + raw[at + 2 :])
    lattice = pieces.Lattice(**loaded)
    words = "the quick brown foxes jumped over Schachtelsatz désolé heitung thonered naïve 2024 wherever".split()
    assert [ids(lattice, "▁" + w) for w in words] == [model.nbest_encode_as_ids(w, 2)[0] for w in words]


def test_query_columns_round_trip(docs, loaded):
    rng = random.Random(6)
    long = " ".join(rng.choice(["the", "other", "ing", "日本", "x" * 70, "", "a\nb"]) for _ in range(9000))
    rows = [(1, "the quick"), (1, "the quick"), (2, None), (3, ""), (4, " "), (5, "a▁b"), (6, long), (6, long), (None, long + "x"), (7, "y" * 40_000)]
    df = docs(rows).withColumn("ids", F.lit("clash")).withColumn("th", F.lit(1))
    assert len(long) > pieces.CHUNK
    found = pieces.with_pieces(df, chunk=1000).collect()
    assert len(found) == len(rows) and all(r.round_trip for r in found)
    lattice = pieces.Lattice(**loaded)
    digest = lambda t: hashlib.sha256(",".join(map(str, ids(lattice, "▁" + t.replace(" ", "▁")) if t else [])).encode()).hexdigest()
    assert sorted((str(r.doc_id), r.ids_sha256) for r in found) == sorted((str(i), digest(t)) for i, t in rows)
    assert pieces.with_pieces(docs([])).count() == 0
    assert pieces.tokenized(docs([(3, "abc")])).columns == ["doc_id", "ids", "n_pieces", "text_sha256"]
