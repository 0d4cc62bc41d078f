import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from heliotab.llm import alignment
from heliotab.llm.registry import QUERIES


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(alignment.BYTE_MODEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL)


def brute(docs, tokenizers):
    """All results by pairs of byte ranges."""
    a_of, b_of = tokenizers
    alphabet = alignment.byte_alphabet()
    per, pairs = [], Counter()
    for doc_id, text, *_ in docs:
        rows, groups = [], []
        if text:
            a, b = a_of.encode(" " + text, add_special_tokens=False).ids, b_of.encode(text)
            a_bytes = [bytes(alphabet[c] for c in a_of.id_to_token(i)) for i in a]
            b_bytes = [bytes([int(p[3:5], 16)]) if b_of.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_of.id_to_piece(i)]]
            if b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
                ea, eb = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
                rows = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if max(ea[i] - len(a_bytes[i]), eb[j] - len(b_bytes[j])) < min(ea[i], eb[j])]
                lo = (0, 0)
                for e in sorted(set(ea.tolist()) & set(eb.tolist())):
                    hi = (int(np.searchsorted(ea, e)) + 1, int(np.searchsorted(eb, e)) + 1)
                    groups.append(",".join(map(str, a[lo[0] : hi[0]])) + "|" + ",".join(map(str, b[lo[1] : hi[1]])))
                    lo = hi
        pairs.update(rows)
        per.append((doc_id, len(a) if rows else 0, len(b) if rows else 0, groups, rows))
    most = {}
    for (_, y), n in pairs.items():
        most[y] = max(n, most.get(y, 0))
    out = [
        (i, na, nb, len(g), len(r), sum(pairs[p] == most[p[1]] for p in r), sum(pairs[p] for p in r), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, na, nb, g, r in per
    ]
    return sorted(out, key=repr), {(x, y, n, n == most[y]) for (x, y), n in pairs.items()}


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    "The quick brown fox", "", None, " ", "  two  blanks ", "Größe über alles, naïve façade", "中文 字符 and 日本語", "emoji 👩‍👩‍👧 \U0001f600!", "▁ marked",
    "<|endoftext|> <s> </s> <unk> <0x41>", "a\x00b\x01", "tab\tline\nend\r\n", "ﬁne ½ x² Å", "don't we'll I'M", "x" * 300, "1234567890" * 20,
    "The quick brown fox", "   ", "\n", " nbsp wide", "é combining", "naïve façade " * 30,
]


def run(spark, docs, **kw):
    df = docs.withColumns({"block": F.lit("clash"), "a": F.lit(1), "kinds": F.lit("x")})
    found, pairs = alignment.align(df, **kw)
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=repr), {tuple(r) for r in pairs.collect()}


@pytest.mark.parametrize("block,size", [(12 << 20, 1 << 20), (300, 60), (1, 1)])
def test_equals_brute_force(spark, docs, tokenizers, block, size):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, "same id"), (3, "same id")]
    assert run(spark, docs(rows), block=block, size=size) == brute(rows, tokenizers)


def test_random_texts(spark, docs, tokenizers):
    rng = random.Random(3)
    words = "alpha Beta über straße 東京 données 42 3.14 -- ... don't \n\n \t <s> 👍 ▁ x=y; ünïcödé".split(" ")
    rows = [(i, " ".join(rng.choice(words) + rng.choice(("", "s", "ing", ",")) for _ in range(rng.randrange(1, 60)))) for i in range(120)]
    assert run(spark, docs(rows, 4), block=4000, size=700) == brute(rows, tokenizers)


def test_empty_table_and_giant_text(spark, docs, tokenizers):
    assert run(spark, docs([])) == ([], set())
    rng = random.Random(5)
    giant = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(1200))
    rows = [(1, giant), (2, "short one"), (3, "z" * 3000)]
    assert run(spark, docs(rows), size=500) == brute(rows, tokenizers)


def test_tokens_equal_those_of_the_file(tokenizers):
    """Ranks alone and the file's merges give the same ids, also for every token of the vocabulary and for long runs."""
    with open(alignment.BYTE_MODEL, "rb") as f:
        mine = alignment.ByteTokenizer(f.read())
    assert mine.fast is not None
    rng = random.Random(1)
    plain = [t.decode() for t in mine.tokens if "�" not in t.decode("utf-8", "replace")]
    texts = plain[::7] + ["".join(rng.choice(plain) for _ in range(rng.randrange(2, 20))) for _ in range(3000)]
    texts += ["".join(map(chr, (rng.randrange(1, 0xD800) for _ in range(20)))) for _ in range(1000)]
    texts += [" " * 200_000 + "x", "\n " * 100_000, "a" * 100_000]
    for text in texts:
        assert mine.ids(text).tolist() == tokenizers[0].encode(text, add_special_tokens=False).ids


def test_links_are_filled_backwards():
    a, b = pa.table({"end": [2, 5, 6], "id": [7, 8, 9]}), pa.table({"end": [1, 5, 6], "id": [3, 4, 5]})
    end, x, y = alignment.links(a, b)
    assert end.tolist() == [1, 2, 5, 6]
    assert (x & ~alignment.END).tolist() == [7, 7, 8, 9] and (y & ~alignment.END).tolist() == [3, 4, 4, 5]
    encoded, last = alignment.groups(x, y)
    assert last.tolist() == [2, 3] and alignment.spelled(encoded.dictionary).to_pylist() == ["7,8|3,4", "9|5"]


def test_registered_query(spark, docs, sf, tokenizers):
    rows = list(enumerate(TEXTS))
    assert sorted((tuple(r) for r in QUERIES["op13_tokenizer_alignment"](spark, sf(documents=docs(rows))).collect()), key=repr) == brute(rows, tokenizers)[0]
