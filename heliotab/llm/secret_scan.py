"""Secret scan with DataFrame functions only: rules, and character Markov models for the rest.

Rules find assignments, access keys and hexadecimal runs. Two first-order character models, one of
random strings and one of ordinary identifiers, then score every long token that no rule covers. A
token is cut at its separators (``/ + = _ -``) first, in training as in scanning, so separators say nothing. A
segment favours the random model if its log-likelihood ratio is above zero; a run of such segments is added as
kind ``random`` if it is long enough and its mean ratio per transition reaches the threshold. Segments of fewer than
``SHORT`` characters neither end a run nor belong to its ends. A segment without a digit must pass in lower case
too, since ordinary words in capitals are rare in a sample. A UUID and a segment of digits alone are identifiers by their shape, not secrets.

Both models are counted from labelled samples: random strings are made from ``DIGESTS`` digests (base64,
base32, base62-like and hexadecimal) and the values that rules find in about ``TRAIN_DOCS`` documents if they mix digits and letters;
ordinary ones are the distinct other identifiers of these documents, and those of the session's
list of settings with its English explanations. A quarter of both samples is held out from the counts. From it the threshold is taken:
half way between the mean ratio that ``FALSE_ALARMS`` of ordinary compounds (four identifiers in a row) exceed and the one that
``MISSES`` of random strings of ``TOKEN_LEAST`` characters fall short of.

Places are running sums over matches, taken in blocks of the square root of their number, so a text with a million
matches costs a thousand times as much as one with ten thousand and not ten thousand times.

Defined results: a null text counts as empty and has no spans; very long texts are scanned whole; repeated rows
each give a row; spans of one kind do not overlap, spans of different kinds may; ties of start are ordered by kind
as listed; an empty table gives no rows; other columns are not read (``redact`` passes them through).
"""

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .registry import query, table

# The base rules, in the order of their kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
VALUE_CHARS = 6

TOKEN_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
TOKEN_LEAST = 20
TOKEN = rf"[A-Za-z0-9+/_=-]{{{TOKEN_LEAST},}}"
SEPARATOR = "[/+=_-]"
UUID = "(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{6,}"
SHORT = 4  # characters of a segment that says too little alone
TRAIN_DOCS = 2_000
DIGESTS = 2_000
FALLBACK = 50.0  # weight of the character frequencies in a transition
FALSE_ALARMS = 0.001  # of held-out ordinary compounds
MISSES = 0.02  # of held-out random strings of the least length
KINDS = ["assign", "access", "hex", "random"]
SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


class Model(NamedTuple):
    """Log-likelihood ratio of each pair of characters, random over ordinary, and the mean that a run must reach."""

    ratios: list[float]
    threshold: float


def no_spans() -> Column:
    return F.expr(f"cast(array() as {SPAN})")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named within a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def blocks_of(array: Column) -> Column:
    """An array in consecutive blocks of about the square root of its length."""

    def cut(a: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(a))), F.lit(1)).cast("int")
        firsts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(a) / width).cast("int") - 1, F.lit(0)))
        return bound(width, lambda w: F.transform(firsts, lambda i: F.slice(a, i * w + 1, w)))

    return bound(array, cut)


def running(lengths: Column, start: Column) -> Column:
    """``start`` and the sums of the lengths before each element."""
    none = F.expr("cast(array() as array<int>)")
    first = F.struct(start.cast("int").alias("at"), none.alias("out"))
    walk = lambda s, n: F.struct((s["at"] + n).alias("at"), F.array_append(s["out"], s["at"]).alias("out"))
    return F.aggregate(lengths, first, walk)["out"]


def places_of(lengths: Column) -> Column:
    """Running sums of many lengths before each, block by block."""

    def within(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, n: s + n))
        return F.flatten(F.zip_with(blocks, running(totals, F.lit(0)), running))

    return bound(blocks_of(lengths), within)


def spans_of(text: Column, pattern: str, rank: int, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches with their places in code points.

    The text between matches and the matches themselves are cut out in step, so a place is the sum
    of the lengths before it. ``least`` is the length that ``group`` needs.
    """
    length = lambda c: F.coalesce(F.char_length(c), F.lit(0))
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    walk = F.zip_with(gaps, hits, lambda gap, hit: F.struct(length(gap).alias("gap"), length(hit).alias("n"), hit.alias("hit")))

    def placed(x: Column, at: Column) -> Column:
        start, hit = at + x["gap"], x["hit"]
        value = F.regexp_extract(hit, pattern, group) if group else hit
        return F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x["n"]).alias("end"), value.alias("value"))

    found = bound(walk, lambda w: F.zip_with(w, places_of(F.transform(w, lambda x: x["gap"] + x["n"])), placed))
    found = F.filter(found, lambda x: F.char_length(x["value"]) >= max(least, 1))
    return F.when(text.rlike(pattern), found).otherwise(no_spans())


def base_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": spans_of(text, ASSIGN, 0, 2, VALUE_CHARS),
        "access": spans_of(text, ACCESS, 1),
        "hex": spans_of(text, HEX, 2),
    }


def pairs_of(string: Column) -> Column:
    """Each character with the next one, in a number of steps that is linear in the string."""
    chars = F.filter(F.split(string, ""), lambda c: c != "")
    n = F.greatest(F.size(chars) - 1, F.lit(0))
    return F.zip_with(F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n), lambda a, b: F.concat(a, b))


def transitions(strings: DataFrame) -> DataFrame:
    """How often one character follows another in a column of strings."""
    pairs = strings.filter(F.char_length("s") > 1).select("label", F.explode(pairs_of(F.col("s"))).alias("pair"))
    return pairs.groupBy("label", "pair").count()


def segments(strings: DataFrame) -> DataFrame:
    """The parts of strings between separators."""
    return strings.withColumn("s", F.explode(F.split("s", SEPARATOR, -1)))


def samples(docs: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """(s, label, held): distinct strings, label 1 random and 0 ordinary; a quarter is held out."""
    spark, total = docs.sparkSession, max(1, docs.count())
    # Rows without an id, or that share one, are told apart by their texts.
    sample = docs.filter(F.pmod(F.xxhash64(id_col, text_col), F.lit(total)) < most).select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rules = base_spans(F.col("text"))
    values = sample.select(F.explode(F.transform(F.concat(*rules.values()), lambda s: s["value"])).alias("s"))
    values = values.filter((F.char_length("s") >= TOKEN_LEAST) & F.col("s").rlike("[0-9]") & F.col("s").rlike("[A-Za-z]"))
    digest = F.sha2(F.col("id").cast("string"), 512)
    coded = F.base64(F.unhex(F.substring(digest, 1, 96)))
    # The digits 1, 8, 9 and 0 of a base32-like string give way to letters that hexadecimal lacks.
    upper = F.translate(F.upper(coded), "0189+/", "GQXZKW")
    made = spark.range(DIGESTS).select(
        F.explode(F.array(coded, F.translate(coded, "+/", "qR"), upper, F.substring(digest, 1, 40), F.translate(F.lower(coded), "+/", "k7"))).alias("s")
    )
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX, UUID):
        rest = F.regexp_replace(rest, pattern, " ")
    plain = sample.select(F.explode(F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))).alias("s"))
    settings = spark.sql("SET -v").select(F.concat_ws(" ", "key", "meaning").alias("text"))
    plain = plain.union(settings.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("s")))
    both = values.union(made).withColumn("label", F.lit(1)).unionByName(plain.withColumn("label", F.lit(0)))
    return both.groupBy("s").agg(F.min("label").alias("label")).withColumn("held", F.pmod(F.xxhash64("s", F.lit(3)), F.lit(4)) == 0)


def ratios(counted: DataFrame) -> list[float]:
    """The ratio of every pair from the transitions of two labels."""
    # At most two labels times the square of the alphabet, so this is small whatever the corpus.
    rows = counted.filter(F.translate("pair", TOKEN_CHARS, "") == "").collect()
    seen = {(r.label, r.pair): r["count"] for r in rows}
    n = len(TOKEN_CHARS)
    after = {(k, a): sum(seen.get((k, a + b), 0) for b in TOKEN_CHARS) for k in (0, 1) for a in TOKEN_CHARS}
    into = {(k, b): sum(seen.get((k, a + b), 0) for a in TOKEN_CHARS) for k in (0, 1) for b in TOKEN_CHARS}
    all_ = {k: sum(after[k, a] for a in TOKEN_CHARS) for k in (0, 1)}

    def log_p(k: int, a: str, b: str) -> float:
        alone = (into[k, b] + 1.0) / (all_[k] + n)
        return math.log((seen.get((k, a + b), 0) + FALLBACK * alone) / (after[k, a] + FALLBACK))

    def pair(a: str, b: str) -> float:
        value = log_p(1, a, b) - log_p(0, a, b)
        return min(value, 0.0) if a == b else value  # rulers are ordinary

    return [pair(a, b) for a in TOKEN_CHARS for b in TOKEN_CHARS]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS) -> Model:
    """Both models and the threshold."""
    labelled = settle(samples(docs, id_col, text_col, most), "labelled")
    known = ratios(transitions(segments(labelled.filter(~F.col("held"))).select("label", "s")))
    held = labelled.filter("held")
    compounds = held.filter("label = 0").groupBy(F.pmod(F.xxhash64("s", F.lit(9)), F.lit(DIGESTS)).alias("g"))
    compounds = compounds.agg(F.slice(F.array_sort(F.collect_list(F.substring("s", 1, 64))), 1, 4).alias("four"))
    ordinary = compounds.select(F.lit(0).alias("label"), F.regexp_replace(F.array_join("four", ""), SEPARATOR, "").alias("s"))
    strings = held.filter("label = 1").select("label", F.substring(F.regexp_replace("s", SEPARATOR, ""), 1, TOKEN_LEAST).alias("s"))
    scored = ordinary.union(strings).filter(F.char_length("s") >= TOKEN_LEAST)
    mean = score(F.col("s"), known) / (F.char_length("s") - 1)
    low, high = (F.percentile(F.when(F.col("label") == k, mean), p) for k, p in ((0, 1 - FALSE_ALARMS), (1, MISSES)))
    least, most_ = scored.agg(low.alias("low"), high.alias("high")).first()
    return Model(known, ((0.0 if least is None else least) + (most_ or 0.0)) / 2)


def ratio(segment: Column, known: list[float]) -> Column:
    """Log-likelihood ratio of a string under the two models."""
    table_ = F.split(F.lit(",".join(f"{x:.6f}" for x in known)), ",").cast("array<double>")
    number = lambda c: F.instr(F.lit(TOKEN_CHARS), c) - 1
    return F.aggregate(
        pairs_of(segment),
        F.lit(0.0),
        lambda total, p: total + F.get(table_, number(F.substring(p, 1, 1)) * len(TOKEN_CHARS) + number(F.substring(p, 2, 1))),
    )


def score(segment: Column, known: list[float]) -> Column:
    """The ratio; without a digit the lesser one of the string as it is and in lower case."""
    forms = F.when(segment.rlike("[0-9]"), F.array(segment)).otherwise(F.array(segment, F.lower(segment)))
    return F.array_min(F.transform(forms, lambda s: ratio(s, known)))


def random_runs(t: Column, model: Model) -> Column:
    """Runs of a token's segments that favour the random model and reach its threshold."""
    zero = F.lit(0.0)

    def closed(state: Column) -> Column:
        begin, end = state["begin"], state["end"]
        value = F.substring(t["value"], begin + 1, end - begin)
        span = F.struct((t["start"] + begin).alias("start"), F.lit(3).alias("rank"), (t["start"] + end).alias("end"), value.alias("value"))
        good = (begin >= 0) & (end - begin >= TOKEN_LEAST) & (state["sum"] >= model.threshold * state["pairs"])
        return F.when(good, F.array_append(state["out"], span)).otherwise(state["out"])

    def step(state: Column, x: Column) -> Column:
        at, end = state["at"], state["at"] + x["n"]
        short = x["n"] < SHORT
        good = ~short & (x["score"] > 0)
        fresh = good & (state["begin"] < 0)
        return F.struct(
            (end + 1).alias("at"),
            F.when(short, state["begin"]).when(~good, F.lit(-1)).when(fresh, at).otherwise(state["begin"]).alias("begin"),
            F.when(good, end).otherwise(state["end"]).alias("end"),
            F.when(good, F.when(fresh, zero).otherwise(state["sum"]) + x["score"]).otherwise(state["sum"]).alias("sum"),
            F.when(good, F.when(fresh, F.lit(0)).otherwise(state["pairs"]) + x["n"] - 1).otherwise(state["pairs"]).alias("pairs"),
            F.when(short | good, state["out"]).otherwise(closed(state)).alias("out"),
        )

    # Scored before the walk: an expression is copied wherever the walk names it, with the whole model.
    parts = F.split(F.regexp_replace(t["value"], UUID, "=" * 36), SEPARATOR, -1)
    scored = F.transform(parts, lambda x: F.struct(F.char_length(x).alias("n"), F.when((F.char_length(x) >= SHORT) & x.rlike("[A-Za-z]"), score(x, model.ratios)).otherwise(zero).alias("score")))
    start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("begin"), F.lit(0).alias("end"), zero.alias("sum"), F.lit(0).alias("pairs"), no_spans().alias("out"))
    return F.aggregate(scored, start, step, closed)


def blanked(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """The text with blanks in the place of every match, so that all other places stay."""
    walk = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def piece(x: Column) -> Column:
        hit, blank = F.coalesce(x["hit"], F.lit("")), F.repeat(F.lit(" "), F.coalesce(F.char_length(x["hit"]), F.lit(0)))
        return F.concat(x["gap"], F.when(F.char_length(F.regexp_extract(hit, pattern, group)) >= least, blank).otherwise(hit) if least else blank)

    return F.when(text.rlike(pattern), F.array_join(F.transform(walk, piece), "")).otherwise(text)


def scan(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with arrays ``__assign``, ``__access``, ``__hex``, ``__base`` and ``__random`` of spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.withColumns({f"__{k}": c for k, c in base_spans(text).items()}).withColumn("__left", blanked(text, ASSIGN, 2, VALUE_CHARS))
    for pattern in (ACCESS, HEX):
        found = found.withColumn("__left", blanked(F.col("__left"), pattern))
    found = found.withColumns({"__base": F.concat("__assign", "__access", "__hex"), "__tokens": spans_of(F.col("__left"), TOKEN, 3)})
    return found.withColumn("__random", F.flatten(F.transform("__tokens", lambda t: random_runs(t, model)))).drop("__tokens", "__left")


def written(spans: Column) -> Column:
    """kind:start:end of all spans by start, then kind."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", chars_col: str | None = "n_chars", marker: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by a marker; texts without one stay as they are."""
    found = scan(docs, train(docs, id_col, text_col), text_col)
    text = F.col(text_col)
    blocks = F.transform(blocks_of(F.array_sort(F.concat("__base", "__random"))), lambda b: F.struct(b.alias("spans"), F.array_max(F.transform(b, lambda x: x["end"])).alias("top")))
    tops = F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out")),
        lambda s, b: F.struct(F.greatest(s["at"], b["top"]).alias("at"), F.array_append(s["out"], s["at"]).alias("out")),
        lambda s: s["out"],
    )
    # Each block of spans rewrites its own part of the text.
    parts = F.transform(
        F.arrays_zip(blocks.alias("b"), tops.alias("lo")),
        lambda x: F.struct(x["lo"].alias("lo"), x["b"]["spans"].alias("spans"), F.substring(text, x["lo"] + 1, F.greatest(x["b"]["top"] - x["lo"], F.lit(0))).alias("part")),
    )

    def rewritten(x: Column) -> Column:
        def step(s: Column, span: Column) -> Column:
            before = F.substring(x["part"], s["at"] - x["lo"] + 1, span["start"] - s["at"])
            out = F.when(span["start"] >= s["at"], F.concat(s["out"], F.array(before, F.lit(marker)))).otherwise(s["out"])
            return F.struct(F.greatest(s["at"], span["end"]).alias("at"), out.alias("out"))

        first = F.struct(x["lo"].alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
        return F.aggregate(x["spans"], first, step, lambda s: F.array_join(s["out"], ""))

    end = F.array_max(F.transform(F.concat("__base", "__random"), lambda x: x["end"]))
    cut = F.concat(F.array_join(F.transform(parts, rewritten), ""), F.substring(text, end + 1, F.char_length(text)))
    hit = F.size("__base") + F.size("__random") > 0
    found = found.withColumn("__new", F.when(hit, cut).otherwise(text))
    new = {text_col: F.col("__new")}
    if chars_col and chars_col in docs.columns:
        new[chars_col] = F.when(hit, F.char_length("__new").cast(docs.schema[chars_col].dataType)).otherwise(F.col(chars_col))
    return found.select(*[new.get(n, F.col(f"`{n}`")).alias(n) for n in docs.columns])


@query("op10_secret_scan")
def op10(spark, sf_dir):
    """Spans of secrets in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    count = lambda k: F.size(f"__{k}").cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(written(F.col("__base")), 256).alias("base_sha256"),
        written(F.concat("__base", "__random")).alias("spans"),
    )
