import hashlib
import random

from pyspark.sql import functions as F

from heliotab.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["\\", "<", "</turn>", "</turn>\n", "<next/>", "### ", "#\\## ", "<\\/turn>", "<\\next/>", ": ", ":\\ ", "é", "\n", "user", "$1", "", "#"]


def rows_of(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(30):
        for t in range(rng.choice([1, 2, 9])):
            role = rng.choice(["user", "assistant", "assistant", "sys: tem", "a\\: b:", "", None])
            rows.append((c, t, role, rng.choice([None, "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 12)))])))
    rows += [(50, 1, "user", "b"), (50, 1, "user", "a"), (50, 1, "user", "a"), (50, None, "assistant", "first"), (None, 0, "assistant", "x" * 100_000)]
    return rows


def test_turns_and_loss_are_read_back(spark):
    rows = rows_of(1)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("turns", F.lit(1)).withColumn("formatted", F.lit("clash")).repartition(5)
    out = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(out) == set(by)
    for c, turns in by.items():
        turns = [(role, text) for _, _, role, text in sorted(turns)]
        assert [tuple(t) for t in out[c].turns] == turns
        assert out[c].loss_texts == [t for r, t in turns if r == "assistant"]
        assert sum(m.chars for m in out[c].loss_mask) == len(out[c].formatted)
        assert sum(m.bytes for m in out[c].loss_mask) == len(out[c].formatted.encode())


def test_adjacent_turns_of_a_role_are_one_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "</turn> ### x")]
    out = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).first()
    assert out.formatted == "### user: a<next/>b</turn>\n### assistant: <\\/turn> #\\## x</turn>\n"
    assert [m.chars for m in out.loss_mask if m.loss] == [len("<\\/turn> #\\## x")]


def test_probe_and_empty_table(spark, sf):
    none = sf(conversations=spark.createDataFrame([], SCHEMA))
    r = chat.op1(spark, none).collect()
    assert len(r) == 1 and r[0].conv_id == -7 and r[0].n_turns == 2 and r[0].loss_chars == len(chat.PROBE)
    assert r[0].loss_sha256 == hashlib.sha256(chat.PROBE.encode()).hexdigest()
