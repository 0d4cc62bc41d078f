"""Repair of conversations: faults per turn and the cheapest edits that give a well-formed sequence of roles.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. Its turns can be kept (0),
given the role user or assistant (2), deleted (3; forced for blank turns and repeats), and empty turns of
user or assistant can be inserted anywhere (2); a truncated turn that stays costs 1 more. Of the
cheapest sequences of edits the one whose initials (D, I, K, R) come first in ASCII order is taken.

Rows are repartitioned by conversation, sorted by turn, and streamed: ``mapInPandas`` carries the state of a
dynamic program across Arrow batches. The program holds, for each of the four places in the pattern, the
least cost and how its edits compare with those of the other places: two sequences that used up the same turns and end in
different turn edits differ within both, so their order never changes, and those with the same end
differ in trailing insertions only. Costs relative to the least and these ranks take few values,
so a step is one look-up in a table of transitions that fills itself, and its number is all that a turn leaves behind:
two bytes that name the best predecessor of every place. Numbers and texts of a conversation beyond ``SPILL`` bytes
go to an unnamed temporary file of the task until its last turn, when they are traced back and read once more;
only the string of edits, one byte each, grows with the conversation.

Repeats are found by a window in the same partitioning, which sorts and spills; no set of seen texts is held.

Defined results: a null role or text counts as one blank; null turns come first; rows equal in turn are ordered by
role, text and lastly the faults; the first of equal rows is no repeat; a null conversation id is a
conversation of its own; a conversation of which no row is live has empty edits; an empty table gives no rows;
columns of other names are not read.
"""

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .registry import query, table

SPACES = " \t\n\x0b\f\r"
START, SYSTEM, USER, ASSISTANT = range(4)  # places in the pattern: what the last turn was
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
# No place can win that costs so much more than another: four insertions lead from any place to any other.
FAR = 12
INITIALS = "sua"
SPILL = 8 << 20
CHUNK = 1 << 16
OUT_ROWS, OUT_BYTES = 10_000, 4 << 20
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NAMES = {"u": "user", "a": "assistant"}


def expected(place: int) -> str:
    """The role that an edit gives at a place."""
    return "a" if place == USER else "u"


def with_insertions(best: list) -> list:
    """Places reached by insertions behind the last turn; entries are (cost, end, insertions, origin)."""
    for _ in range(3):
        for place in range(4):
            if best[place] is None:
                continue
            cost, end, k, origin = best[place]
            to = AFTER[place, expected(place)]
            if best[to] is None or (cost + INSERT, end) < best[to][:2]:
                best[to] = (cost + INSERT, end, k + 1, origin)
    return best


def settled(best: list) -> tuple[tuple, int]:
    """Costs above the least, ranks of the ends, insertions; and the least cost."""
    low = min(b[0] for b in best if b)
    best = [b if b and b[0] - low <= FAR else None for b in best]
    ends = sorted({b[1] for b in best if b})
    return tuple(b and (b[0] - low, ends.index(b[1]), b[2]) for b in best), low


FIRST = settled(with_insertions([(0, (0, ""), 0, None), None, None, None]))[0]


@lru_cache(None)
def step(state: tuple, kind: int) -> tuple[tuple, int, tuple]:
    """The state after a turn, what the least cost grows by, and per place (place before, edit, insertions after)."""
    initial, deleted, truncated = (INITIALS + "?")[kind >> 2], kind >> 1 & 1, TRUNCATED * (kind & 1)
    found: list = [None] * 4
    for place, held in enumerate(state):
        if held is None:
            continue
        cost, rank, k = held
        options = [(place, "D", DELETE)]
        if not deleted:
            options.append((AFTER[place, expected(place)], "R", REROLE + truncated))
            if (place, initial) in AFTER:
                options.append((AFTER[place, initial], "K", KEEP + truncated))
        for to, edit, price in options:
            new = (cost + price, (rank, "I" * k + edit), 0, (place, edit))
            if found[to] is None or new[:2] < found[to][:2]:
                found[to] = new
    found = with_insertions(found)
    after, low = settled(found)
    return after, low, tuple(f and (*f[3], f[2]) for f in found)


class Transitions:
    """Numbers for states and steps, so that a step is a look-up and its number a backpointer for all places."""

    def __init__(self):
        self.states, self.known = {FIRST: 0}, [FIRST]
        self.steps: dict[tuple[int, int], tuple[int, int, int]] = {}
        self.back: list[tuple] = []

    def take(self, state: int, kind: int) -> tuple[int, int, int]:
        """(state, cost, number) of a step."""
        after, low, back = step(self.known[state], kind)
        if after not in self.states:
            self.states[after] = len(self.known)
            self.known.append(after)
        if len(self.back) >= 1 << 16:
            raise OverflowError("a backpointer has two bytes")
        self.back.append(back)
        made = self.steps[state, kind] = self.states[after], low, len(self.back) - 1
        return made


TABLE = Transitions()


class Spool:
    """Items in order, in memory up to ``SPILL`` bytes and in a temporary file of the task beyond."""

    def __init__(self):
        self.items, self.size, self.file = [], 0, None

    def add(self, item, size: int) -> None:
        self.items.append(item)
        self.size += size
        if self.size > SPILL:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.items, self.file, pickle.HIGHEST_PROTOCOL)
            self.items, self.size = [], 0

    def read(self) -> Iterator:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
            self.file.close()
        yield from self.items


class Numbers:
    """Two-byte numbers, written in order and read backwards."""

    def __init__(self):
        self.held, self.file, self.blocks = array("H"), None, 0

    def add(self, number: int) -> None:
        self.held.append(number)
        if len(self.held) == SPILL // 2:
            self.file = self.file or tempfile.TemporaryFile()
            self.held.tofile(self.file)
            self.blocks, self.held = self.blocks + 1, array("H")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.held)
        for block in reversed(range(self.blocks)):
            part = array("H")
            self.file.seek(block * SPILL)
            part.fromfile(self.file, SPILL // 2)
            yield from reversed(part)
        if self.file:
            self.file.close()


class Conversation:
    """State carried from turn to turn of one conversation."""

    def __init__(self, key):
        self.key, self.state, self.total = key, 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.last = None
        self.numbers, self.texts = Numbers(), Spool()

    def add(self, turn: int | None, role: str, text: str, kind: int, fault: int) -> None:
        """One live row in order; ``fault`` is 0 none, 1 blank, 2 duplicate, 3 truncated."""
        self.blank += fault == 1
        self.duplicate += fault == 2
        self.truncated += fault == 3
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most, self.turns = turn, self.turns + 1
        self.state, low, number = TABLE.steps.get((self.state, kind)) or TABLE.take(self.state, kind)
        self.total += low
        self.numbers.add(number)
        self.texts.add((role, text), len(role) + len(text) + 64)

    def edits(self) -> tuple[int, str]:
        """The least cost and the edits that have it, first in ASCII order."""
        state = TABLE.known[self.state]
        place = min((p for p in (START, ASSISTANT) if state[p]), key=lambda p: state[p])
        cost, out = self.total + state[place][0], bytearray()
        for number in self.numbers.backwards():
            place, edit, k = TABLE.back[number][place]
            out += b"I" * k + edit.encode()
        out += b"I" * FIRST[place][2]
        return cost, out[::-1].decode()

    def gaps(self) -> int:
        return 0 if self.most is None else min(self.most - self.least + 1 - self.turns, (1 << 63) - 1)

    def repaired(self, edits: str) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of the turns of the repaired conversation."""
        rows, place = self.texts.read(), START
        for edit in edits:
            role, text = ("", "") if edit == "I" else next(rows)
            if edit == "D":
                continue
            if edit == "K":
                place = AFTER[place, role[0]]
            else:
                place, role = AFTER[place, expected(place)], NAMES[expected(place)]
            yield role, text, edit


def conversations(frames: Iterator[pd.DataFrame]) -> Iterator[Conversation]:
    """Conversations of a stream of rows in order, across the borders of its frames."""
    now = None
    for frame in frames:
        columns = (frame[c].tolist() for c in ("conv", "live", "numbered", "turn", "role", "text", "kind", "fault"))
        for key, live, numbered, turn, role, text, kind, fault in zip(*columns):
            if now is None or key != now.key:
                if now:
                    yield now
                now = Conversation(key)
            if live:
                now.add(turn if numbered else None, role, text, kind, fault)
    if now:
        yield now


def gathered(rows: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of a bounded number of rows and bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= OUT_ROWS or size >= OUT_BYTES:
            yield pd.DataFrame(held, columns=names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


def ordered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, live: Column | None) -> DataFrame:
    """Rows by conversation in the order of their turns, with faults and the kind of each row."""
    text, role = F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")), F.coalesce(F.col(f"`{role_col}`"), F.lit(" "))
    turn = F.col(f"`{turn_col}`").cast("long")
    rows = df.select(
        F.col(f"`{conv_col}`").alias("id"), turn.alias("turn"), role.alias("role"), text.alias("text"),
        (F.lit(True) if live is None else F.coalesce(live, F.lit(False))).alias("live"),
    ).repartition("id")
    seen = Window.partitionBy("id", "live", "role", "text").orderBy(F.asc_nulls_first("turn"))
    end = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    rows = rows.withColumn("again", F.row_number().over(seen) > 1).withColumn(
        "fault",
        F.when(end == "", 1).when(F.col("again"), 2).when(~F.substring(end, -1, 1).isin(".", "!", "?"), 3).otherwise(0),
    )
    code = F.when(initial == "s", 0).when(initial == "u", 4).when(initial == "a", 8).otherwise(12)
    kind = code + F.when(F.col("fault").isin(1, 2), 2).otherwise(0) + F.when(F.col("fault") == 3, 1).otherwise(0)
    order = [F.asc_nulls_first("id"), F.asc_nulls_first("turn"), "role", "text", "again"]
    return rows.sortWithinPartitions(*order).select(
        F.col("id").cast("string").alias("conv"), "live", F.col("turn").isNotNull().alias("numbered"),
        F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", kind.cast("int").alias("kind"), F.col("fault").cast("int").alias("fault"),
    )


NAMED = {"conv_col": "conv_id", "turn_col": "turn", "role_col": "role", "text_col": "text"}


def reports(df: DataFrame, live: Column | None = None, **columns: str) -> DataFrame:
    """Per conversation: faults, the cost, the edits, and a digest of the repaired turns.

    Rows for which ``live`` is not true only make their conversation appear in the result.
    """
    names = NAMED | columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for c in conversations(frames):
                cost, edits = c.edits()
                digest, lead = hashlib.sha256(), ""
                for role, text, _ in c.repaired(edits):
                    digest.update(f"{lead}{role}:{text}".encode())
                    lead = "\n"
                yield c.key, c.gaps(), c.blank, c.duplicate, c.truncated, c.illegal, cost, edits, digest.hexdigest()

        yield from gathered(rows(), ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])

    kind = df.schema[names["conv_col"]].dataType
    schema = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    found = ordered(df, live=live, **names).mapInPandas(run, schema)
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *found.columns[1:])


def repaired(df: DataFrame, live: Column | None = None, **columns: str) -> DataFrame:
    """(conv_id, position, role, text, edit): the turns of every conversation after its repair."""
    names = NAMED | columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((c.key, i, *turn) for c in conversations(frames) for i, turn in enumerate(c.repaired(c.edits()[1])))
        yield from gathered(rows, ["conv", "position", "role", "text", "edit"])

    kind = df.schema[names["conv_col"]].dataType
    found = ordered(df, live=live, **names).mapInPandas(run, "conv string, position long, role string, text string, edit string")
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *found.columns[1:])


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with the faults of the contract, chosen by the checksum of conversation and turn; dropped rows are not ``live``."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = df.select("conv_id", "turn", text.alias("text"), role.alias("role"), fault.alias("harm"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("harm") != 0).alias("live"),
        F.explode(F.when(F.col("harm") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


@query("op12_conversation_repair")
def op12(spark, sf_dir):
    """Faults and cheapest repair of every damaged conversation."""
    return reports(damaged(table(spark, sf_dir, "conversations")), live=F.col("live"))
