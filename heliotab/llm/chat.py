r"""Chat formatting as a relational plan: collected turn structs, arrays and strings only.

The turns of a conversation are sorted, adjacent turns of one role are merged into a block, and blocks are
concatenated: ``### role: text<next/>text</turn>\n``. A backslash in a text is doubled, and a control
string in it gets one after its first character (``<\/turn>``, ``<\next/>``, ``#\## ``; ``:\ `` in a role).
So no control string occurs inside a text, and reading back splits at them and undoes the escapes.

The loss mask is a run-length list over the formatted text: characters, bytes, and whether the loss counts
them. It covers the texts of the loss role, without headers, separators and ends.

Defined results: a null text or role counts as empty; turns are ordered by turn, then role, then text,
null turns first; repeated rows are turns of their own; rows without a conversation id form one of their
own; an empty table gives no rows; other columns are not read. A conversation is one row of the result,
so its turns meet in one task whatever the plan.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table

# The template.
HEAD, COLON, NEXT, END = "### ", ": ", "<next/>", "</turn>\n"
ESCAPES = [("</turn>", "<\\/turn>"), ("<next/>", "<\\next/>"), ("### ", "#\\## ")]
LOSS_ROLE = "assistant"


def escape(text: Column, more: list = ()) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for plain, safe in [*ESCAPES, *more]:
        out = F.replace(out, F.lit(plain), F.lit(safe))
    return out


def unescape(text: Column, more: list = ()) -> Column:
    out = text
    for plain, safe in reversed([*ESCAPES, *more]):
        out = F.replace(out, F.lit(safe), F.lit(plain))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


IN_ROLE = [(": ", ":\\ ")]


def format_chats(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    loss_role: str = LOSS_ROLE,
) -> DataFrame:
    """(conv_id, formatted, loss_mask): one row for each conversation."""
    empty = F.lit("")
    turn = F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), empty).alias("role"), F.coalesce(F.col(text_col), empty).alias("text")
    )
    chats = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # Where a block begins, and where the next one does.
    opens = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    chats = chats.withColumn("opens", opens)
    bounds = F.arrays_zip(F.col("opens").alias("a"), F.concat(F.slice("opens", F.lit(2), F.size("opens")), F.array(F.size("turns"))).alias("b"))

    def piece(text: Column, loss) -> Column:
        loss = F.lit(loss) if isinstance(loss, bool) else loss
        return F.struct(text.alias("s"), loss.alias("loss"))

    def block(z: Column) -> Column:
        role = F.get("turns", z["a"])["role"]
        texts = F.transform(
            F.slice("turns", z["a"] + 1, z["b"] - z["a"]),
            lambda t, i: F.array(piece(F.when(i > 0, F.lit(NEXT)).otherwise(empty), False), piece(escape(t["text"]), t["role"] == loss_role)),
        )
        head = F.concat(F.lit(HEAD), escape(role, IN_ROLE), F.lit(COLON))
        return F.concat(F.array(piece(head, False)), F.flatten(texts), F.array(piece(F.lit(END), False)))

    chats = chats.withColumn("pieces", F.flatten(F.transform(bounds, block)))
    mask = F.transform(
        "pieces", lambda p: F.struct(F.char_length(p["s"]).alias("chars"), F.octet_length(p["s"]).alias("bytes"), p["loss"].alias("loss"))
    )
    return chats.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["s"]), "").alias("formatted"), mask.alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with the turns that its text holds and the texts under its loss mask."""
    blocks = F.filter(F.split("formatted", END, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        at = F.instr(block, COLON)
        role = unescape(F.substring(block, F.lit(len(HEAD) + 1), at - len(HEAD) - 1), IN_ROLE)
        rest = F.substring(block, at + len(COLON), F.char_length(block))
        return F.transform(F.split(rest, NEXT, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    raw = F.col("formatted").cast("binary")
    start = F.struct(F.lit(0).alias("at"), raw.alias("raw"), F.expr("cast(array() as array<string>)").alias("out"))

    def under(state: Column, run: Column) -> Column:
        text = F.substring(state["raw"], state["at"] + 1, run["bytes"]).cast("string")
        return F.struct(
            (state["at"] + run["bytes"]).alias("at"), state["raw"].alias("raw"),
            F.when(run["loss"], F.concat(state["out"], F.array(unescape(text)))).otherwise(state["out"]).alias("out"),
        )

    return formatted.withColumns({
        "turns": F.flatten(F.transform(blocks, turns)),
        "loss_texts": F.aggregate("loss_mask", start, under, lambda s: s["out"]),
    })


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, coalesce(lag(role) OVER w = role, false) AS merged,
         replace(replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '<next/>', '<\next/>'), '### ', '#\## ') AS safe
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(safe) + CASE WHEN merged THEN 7 ELSE 14 + length(role) END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

PROBE = "\\### Assistant: </turn> ok"


@query("op1_chat_formatting", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    found = read_back(format_chats(rows.unionByName(extra)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length(F.array_join("loss_texts", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("loss_texts", ""), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
