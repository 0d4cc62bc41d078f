"""SentencePiece encoding and decoding as a max-plus parallel scan.

A text becomes the sequence of vocabulary pieces with the largest sum of scores (the unigram rule, over
the pieces and scores of a SentencePiece model file). The best path is a product of max-plus matrices,
so a giant text is cut into chunks: each chunk gives the matrix of best scores between the states at
its two boundaries (how far the piece across the boundary reaches into the next chunk), the matrices of
a text are combined associatively, and each chunk then traces its own path back.

Where the vocabulary has no piece with a blank after another character, every path has a boundary
before a blank that ends a word, so a word's best path is the same wherever it stands; it is looked up
once, and the matrix of a chunk is the sum of its parts. Without such places (one giant word, another
vocabulary) the whole matrix is computed.

Ties: at every boundary the longest last piece wins, the same with chunks as without. A character
without a piece becomes its UTF-8 byte pieces, at ``UNKNOWN`` below the least score; scores add up in
double precision, which is exact for integer scores.

Defined results: a null or empty text has no pieces and decodes to the empty text; U+2581 in a text
decodes to a blank, as the format has it (``round_trip`` compares with that); repeated rows each give a
row; an empty table gives no rows; other columns are not read.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .registry import query, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
UNKNOWN = 10.0
CHUNK = 1 << 16  # characters; longer texts are giant and scanned in chunks
MEMO = 160_000  # words remembered by a task at a time
TOGETHER = 1 << 18  # characters encoded together
LONG_WORD = 64  # longer words are taken one by one
LEARNT = 8_192  # words in the lattice together, so that its arrays stay in the cache
HASH = np.uint64(0x9E3779B97F4A7C15)
BUCKET_BITS = 18
FAR = 1e300
NONE = float("-inf")
FIRST = [0.0]  # a path that enters at the first place


def load(path: str = MODEL) -> dict:
    """Pieces and scores of a model file, as plain values."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in normal}
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    names = [model.id_to_piece(i) for i in range(n)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError(f"{path}: no byte pieces for characters without a piece")
    made = Lattice(pieces, byte_ids, names)
    index = made.keys, made.scores, made.numbers, made.bucket, made.probes
    return {"pieces": pieces, "byte_ids": byte_ids, "names": names, "index": index}


class Lattice:
    """Best paths through the pieces of a text."""

    def __init__(self, pieces: dict, byte_ids: list, names: list, index: tuple | None = None):
        self.pieces, self.byte_ids, self.names = pieces, byte_ids, names
        self.longest = max(map(len, pieces))
        self.unknown = min(s for _, s in pieces.values()) - UNKNOWN
        # Score of every piece; a string that only begins one leads on without a score of its own.
        self.score = {p[:k]: NONE for p in pieces for k in range(1, len(p))}
        self.score |= {p: s for p, (_, s) in pieces.items()}
        # No piece may cross from a character to a blank behind it.
        self.cuts = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces)
        self.memo: dict[str, tuple[float, bytes]] = {}
        self.after_blank: dict[str, bytes] = {}  # words met of late, and those before them
        self.older: dict[str, bytes] = {}
        self.one_score, self.one_number = np.full(0x110000, -3 * FAR), np.full(0x110000, -1, np.int32)
        for x, s in self.score.items():
            if len(x) == 1:
                self.one_score[ord(x)] = -FAR if s == NONE else s
                self.one_number[ord(x)] = pieces[x][0] if x in pieces else -1
        # What an id adds to a path; a character without a piece counts once, at its first byte.
        self.worth = np.zeros(len(names))
        for i, s in pieces.values():
            self.worth[i] = s
        for b, i in enumerate(byte_ids):
            self.worth[i] = 0.0 if 0x80 <= b < 0xC0 else self.unknown
        if index is None:
            self.index()
        else:
            self.keys, self.scores, self.numbers, self.bucket, self.probes = index

    def forward(self, text: str, start: np.ndarray, size: int):
        """Best score at every place from scores at the first places; ``size`` is where the chunk ends.

        ``text`` reaches beyond the chunk as far as a piece can. Returns scores and, per place, where
        the last piece begins (-1: the path enters here).
        """
        n, reach, score = len(text), self.longest, self.score.get
        best, back = [NONE] * (n + 1), [-1] * (n + 1)
        best[: len(start)] = list(start[: n + 1])
        for at in range(min(size, n)):
            here = best[at]
            if here == NONE:
                continue
            for end in range(at + 1, min(at + reach, n) + 1):
                s = score(text[at:end])
                if end == at + 1 and (s is None or s == NONE):
                    lead, s = s, self.unknown
                else:
                    lead = s
                if s is not None and here + s > best[end]:  # of equal ones the earliest start stays: the longest piece
                    best[end], back[end] = here + s, at
                if lead is None:
                    break
        return best, back

    def ids(self, piece: str) -> list[int]:
        found = self.pieces.get(piece)
        return [found[0]] if found is not None else [self.byte_ids[b] for b in piece.encode()]

    def path(self, text: str, back: list, end: int) -> tuple[list[int], int]:
        """Ids of the pieces up to ``end``, and the place where the path entered."""
        parts = []
        while back[end] >= 0:
            parts.append(text[back[end] : end])
            end = back[end]
        return [i for p in reversed(parts) for i in self.ids(p)], end

    def word(self, text: str) -> tuple[float, bytes]:
        """Best score and ids (as 32-bit values) of a text that begins and ends at boundaries."""
        known = self.memo.get(text)
        if known is None:
            best, back = self.forward(text, FIRST, len(text))
            known = best[len(text)], np.array(self.path(text, back, len(text))[0], np.int32).tobytes()
            if len(self.memo) >= MEMO // 8:
                self.memo.clear()
            self.memo[text] = known
        return known

    WORDS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")

    def words(self, text: str) -> list[str]:
        """The text at the places where every path has a boundary."""
        return self.WORDS.findall(text) if self.cuts else [text] if text else []

    def encode(self, text: str) -> bytes:
        """Ids of a text that begins and ends at boundaries, as 32-bit values."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Words that were not met before go through the lattice together."""
        out: list[bytes] = []
        lo = 0
        while lo < len(texts):  # as many texts at a time as make up about TOGETHER characters
            hi, size = lo + 1, len(texts[lo])
            while hi < len(texts) and size + len(texts[hi]) <= TOGETHER:
                size += len(texts[hi])
                hi += 1
            out += self._encode(texts[lo:hi])
            lo = hi
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.after_blank) > MEMO // 2:
            self.older, self.after_blank = self.after_blank, {}
        known, older, split = self.after_blank, self.older, []
        for text in texts:
            plain = self.cuts and text[:1] == BLANK and text[-1] != BLANK and BLANK * 2 not in text
            split.append(text[1:].split(BLANK) if plain else None)
        found = [words and list(map(known.get, words)) for words in split]
        new = {w for words, ids in zip(split, found) if ids and None in ids for w, x in zip(words, ids) if x is None}
        known.update({w: older[w] for w in new if w in older})
        self.learn([w for w in new if w not in older])
        out = []
        for text, words, ids in zip(texts, split, found):
            if words is None:
                ids = [self.word(w)[1] for w in self.words(text)]
            elif None in ids:
                ids = map(known.__getitem__, words)
            out.append(b"".join(ids))
        return out

    def learn(self, words: list[str]) -> None:
        """Best paths of many words after a blank, place by place over all words at once."""
        for w in words:
            if len(w) >= LONG_WORD:
                self.after_blank[w] = self.word(BLANK + w)[1]
        words = [w for w in words if len(w) < LONG_WORD]
        for i in range(0, len(words), LEARNT):
            self._learn(words[i : i + LEARNT])

    def _learn(self, words: list[str]) -> None:
        codes = np.frombuffer((BLANK + BLANK.join(words)).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        begin = np.cumsum(size) - size
        stop = np.repeat(begin + size, size)
        # Edges: pieces by their first and last character, the shortest first.
        at = np.arange(len(codes))
        key = np.zeros(len(codes), np.uint64)
        edges = []
        for length in range(1, self.longest + 1):
            key = (key ^ codes[at + length - 1]) * HASH
            if length == 1:
                score, number = self.one_score[codes], self.one_number[codes]
                strange = number < 0
                score, open_ = np.where(strange, self.unknown, score), score > -2 * FAR
                edges.append((at, at, score, number))
            else:
                score, number = self.find(key)
                is_piece, open_ = number >= 0, score > -2 * FAR
                edges.append((at[is_piece], at[is_piece] + length - 1, score[is_piece], number[is_piece]))
            at, key = at[open_], key[open_]
            more = at + length < stop[at]
            at, key = at[more], key[more]
            if not len(at):
                break
        first, last, score, number = (np.concatenate(x) for x in zip(*edges))
        place = first - np.repeat(begin, size)[first]
        order = np.argsort(place, kind="stable")
        first, last, score, number = first[order], last[order], score[order], number[order]
        cut = np.searchsorted(place[order], np.arange(size.max() + 1))
        best, back, which = np.full(len(codes), NONE), np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        for t, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])):
            f, to = first[lo:hi], last[lo:hi]
            total = score[lo:hi] + (best[f - 1] if t else 0.0)
            better = total > best[to]  # of equal ones the earliest start stays: the longest piece
            to = to[better]
            best[to], back[to], which[to] = total[better], f[better], number[lo:hi][better]
        on_path = np.zeros(len(codes), bool)
        here, lowest = begin + size - 1, begin
        while len(here):
            on_path[here] = True
            here = back[here] - 1
            open_ = here >= lowest
            here, lowest = here[open_], lowest[open_]
        ends = np.flatnonzero(on_path)
        ids = which[ends].astype(np.int32)
        rows = np.searchsorted(ends, np.append(begin, len(codes)))
        raw, rows = ids.tobytes(), rows.tolist()
        odd = set(np.searchsorted(rows, np.flatnonzero(ids < 0), "right").tolist())
        for i, w in enumerate(words):
            if i + 1 in odd:  # characters without a piece become bytes
                self.after_blank[w] = b"".join(
                    np.array([k] if k >= 0 else self.ids(chr(int(codes[e]))), np.int32).tobytes()
                    for k, e in zip(ids[rows[i] : rows[i + 1]].tolist(), ends[rows[i] : rows[i + 1]].tolist())
                )
            else:
                self.after_blank[w] = raw[4 * rows[i] : 4 * rows[i + 1]]

    def index(self) -> None:
        """Beginnings of pieces by hash, for ``find``."""
        strings = list(self.score)
        keys = np.zeros(len(strings), np.uint64)
        for k in range(self.longest):
            codes = np.array([ord(x[k]) if len(x) > k else 0 for x in strings], np.uint64)
            keys = np.where([len(x) > k for x in strings], (keys ^ codes) * HASH, keys)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a hash")
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.uint64(0))
        self.scores = np.append(np.array([self.score[strings[i]] for i in order]), NONE)
        self.scores = np.where(self.scores == NONE, -FAR, self.scores)
        self.numbers = np.append(np.array([self.pieces[strings[i]][0] if strings[i] in self.pieces else -1 for i in order]), -1)
        buckets = (self.keys[:-1] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        self.bucket = np.searchsorted(buckets, np.arange((1 << BUCKET_BITS) + 1))
        self.probes = int(np.diff(self.bucket).max())

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of each hash: -FAR and -1 where it only begins a piece, -3 FAR and -1 elsewhere."""
        b = (key >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        lo, hi = self.bucket[b], self.bucket[b + 1]
        score, number = np.full(len(key), -3 * FAR), np.full(len(key), -1)
        open_ = np.flatnonzero(lo < hi)
        for _ in range(self.probes):
            at = lo[open_]
            same = self.keys[at] == key[open_]
            found = open_[same]
            score[found], number[found] = self.scores[at[same]], self.numbers[at[same]]
            lo[open_] += 1
            open_ = open_[~same & (lo[open_] < hi[open_])]
            if not len(open_):
                break
        return score, number

    # --- chunks -------------------------------------------------------------------------------
    # State i at a chunk's start: its first boundary is i characters in. State j at its end likewise.

    def open_parts(self, text: str, size: int) -> tuple[int, int]:
        """Where the first and the last certain boundary within a chunk lie (size, size if there is none)."""
        if not self.cuts:
            return size, size
        first = text.find(BLANK, self.longest, size)
        while first > 0 and text[first - 1] == BLANK:
            first = text.find(BLANK, first + 1, size)
        if first < 0:
            return size, size
        last = text.rfind(BLANK, first, size)
        while last > first and text[last - 1] == BLANK:
            last = text.rfind(BLANK, first, last)
        return first, last

    def leads(self, chunks: list) -> list[dict]:
        """``lead`` of many chunks, whose words are looked up together."""
        parts = [self.open_parts(text, size) for text, size in chunks]
        middles = self.encode_all([text[a:b] for (text, _), (a, b) in zip(chunks, parts) if a < b])
        rest = iter(middles)
        return [self.lead(text, size, *ends, next(rest) if ends[0] < ends[1] else b"") for (text, size), ends in zip(chunks, parts)]

    def lead(self, text: str, size: int, first: int, last: int, middle: bytes) -> dict:
        """What is certain about a chunk before its start is known; ``middle`` are the ids between the certain boundaries.

        Its matrix; the text ``lead`` whose path depends on the start; the ids of the words between the
        first and the last certain boundary; and the rest for each end state. Without a certain
        boundary the lead is the whole chunk.
        """
        n = self.longest
        matrix = np.full((n, n), NONE)
        if first >= size:
            for i in range(n):
                if i >= size:  # a state beyond a chunk shorter than a piece passes through it
                    matrix[i, i - size] = 0.0
                    continue
                best, _ = self.forward(text, [NONE] * i + FIRST, size)
                matrix[i, : len(best[size : size + n])] = best[size : size + n]
            return {"matrix": matrix.tobytes(), "lead": text, "upto": size, "cut": False, "middle": [], "rests": []}
        middle = np.frombuffer(middle, np.int32)
        tail, back = self.forward(text[last:], FIRST, size - last)
        ends = np.array(tail[size - last : size - last + n])
        for i in range(n):
            head, _ = self.forward(text[:first], [NONE] * i + FIRST, first)
            matrix[i, : len(ends)] = head[first] + self.worth[middle].sum() + ends
        rests = [self.path(text[last:], back, size - last + j)[0] if s > NONE else [] for j, s in enumerate(ends.tolist())]
        return {"matrix": matrix.tobytes(), "lead": text[:first], "upto": first, "cut": True, "middle": middle, "rests": rests}

    def trace(self, text: str, upto: int, cut: bool, start: np.ndarray) -> dict:
        """The path of a chunk's lead from the best scores at its start, for each state at the lead's end."""
        best, back = self.forward(text, start.tolist(), upto)
        paths, entries = [], []
        for j in range(1 if cut else self.longest):
            ids, entry = self.path(text, back, upto + j) if upto + j < len(best) and best[upto + j] > NONE else ([], -1)
            paths.append(ids)
            entries.append(entry)
        return {"paths": paths, "entries": entries * self.longest if cut else entries}


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two boundary matrices; associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def scan(matrices: np.ndarray) -> np.ndarray:
    """Best scores at the start of every chunk: prefix products in a logarithmic number of rounds."""
    prefix = matrices.copy()
    step = 1
    while step < len(prefix):
        new = prefix.copy()
        for lo in range(step, len(prefix), 256):
            hi = min(lo + 256, len(prefix))
            new[lo:hi] = (prefix[lo - step : hi - step, :, :, None] + prefix[lo:hi, None, :, :]).max(axis=2)
        prefix, step = new, step * 2
    starts = np.full((len(matrices), matrices.shape[1]), NONE)
    starts[0, 0] = 0.0
    starts[1:] = prefix[:-1, 0, :]
    return starts


LEAD = {
    "matrix": pa.binary(), "lead": pa.string(), "upto": pa.int32(), "cut": pa.bool_(), "middle": pa.list_(pa.int32()),
    "rests": pa.list_(pa.list_(pa.int32())),
}


def plain_hash(text_col: str) -> Column:
    """Hash of the text that a text decodes to; tells rows of equal id apart."""
    return F.xxhash64(F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(BLANK), F.lit(" ")))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, th, ids): the pieces of every text. Texts longer than ``chunk`` go through the scan."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(load(path))
    reach = max(map(len, sent.value["pieces"]))
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), plain_hash(text_col).alias("th"), text.alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(**sent.value)
        for batch in batches:
            found = [b""] * batch.num_rows
            texts = [(i, BLANK + s.replace(" ", BLANK)) for i, s in enumerate(batch.column(2).to_pylist()) if s]
            for (i, _), ids in zip(texts, lattice.encode_all([s for _, s in texts])):
                found[i] = ids
            at = np.cumsum([0, *[len(x) // 4 for x in found]])
            ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))
            yield pa.record_batch([batch.column(0), batch.column(1), ids], names=["doc_id", "th", "ids"])

    keys = f"doc_id {kind}, th long, k int"
    named = ["doc_id", "th", "k"]
    short = rows.filter(F.char_length("text") < chunk).mapInArrow(whole, f"doc_id {kind}, th long, ids array<int>")

    # Giant texts: chunks, each with the characters that a piece can reach beyond it. They are written
    # as they are read, so that the chunks of one text are then shared out among tasks.
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, s in enumerate(batch.column(2).to_pylist()):
                s = BLANK + s.replace(" ", BLANK)
                for lo in range(0, len(s), 64 * chunk):
                    at = range(lo, min(lo + 64 * chunk, len(s)), chunk)
                    one = batch.slice(row, 1).take(pa.array([0] * len(at)))
                    columns = [
                        pa.array([a // chunk for a in at], pa.int32()), pa.array([s[a : a + chunk + reach] for a in at]),
                        pa.array([min(chunk, len(s) - a) for a in at], pa.int32()),
                    ]
                    yield pa.record_batch([one.column(0), one.column(1), *columns], names=[*named, "part", "size"])

    chunks = settle(rows.filter(F.char_length("text") >= chunk).mapInArrow(split, f"{keys}, part string, size int"), "chunks")

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(**sent.value)
        for batch in batches:
            parts = list(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()))
            got = lattice.leads(parts)
            columns = [pa.array([g[x] for g in got], t) for x, t in LEAD.items()]
            yield pa.record_batch([*batch.columns[:3], *columns], names=[*named, *LEAD])

    found = settle(
        chunks.mapInArrow(leads, f"{keys}, matrix binary, lead string, upto int, cut boolean, middle array<int>, rests array<array<int>>"),
        "leads",
    )

    def prefixes(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("k").sort_values("k")  # equal rows have equal chunks
        starts = scan(np.stack([np.frombuffer(m).reshape(reach, reach) for m in part["matrix"]]))
        return part[named].assign(start=[s.tobytes() for s in starts])

    def same(a: str, b: str, *more: str) -> Column:
        out = F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))
        for m in more:
            out = out & (F.col(f"{a}.{m}") == F.col(f"{b}.{m}"))
        return out

    starts = found.select(*named, "matrix").groupBy("doc_id", "th").applyInPandas(prefixes, f"{keys}, start binary")

    def traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(**sent.value)
        for batch in batches:
            rows_ = zip(*[batch.column(i).to_pylist() for i in (3, 4, 5, 6)])
            got = [lattice.trace(s, n, cut, np.frombuffer(v)) for s, n, cut, v in rows_]
            columns = [
                pa.array([g["paths"] for g in got], pa.list_(pa.list_(pa.int32()))),
                pa.array([g["entries"] for g in got], pa.list_(pa.int32())),
            ]
            yield pa.record_batch([*batch.columns[:3], *columns], names=[*named, "paths", "entries"])

    # Chunks of equal rows are alike; one of each is traced.
    ready = found.select(*named, "lead", "upto", "cut").dropDuplicates(named).alias("c").join(starts.alias("v"), same("c", "v", "k"))
    ready = ready.select("c.*", "v.start")
    traced = ready.mapInArrow(traces, f"{keys}, paths array<array<int>>, entries array<int>")

    def exits(part: pd.DataFrame) -> pd.DataFrame:
        """Each chunk's end state is the state at which the next one was entered."""
        part = part.sort_values("k")
        state, states = 0, []
        for entries in reversed(part["entries"].tolist()):
            states.append(state)
            state = entries[state]
        chosen = [p[0 if len(p) == 1 else s] for p, s in zip(part["paths"], reversed(states))]
        return part[["doc_id", "th"]].head(1).assign(states=[states[::-1]], heads=[chosen])

    states = traced.groupBy("doc_id", "th").applyInPandas(exits, f"doc_id {kind}, th long, states array<int>, heads array<array<int>>")
    # The ids move once, by text; the states of a text are few.
    chunk_ids = F.struct("k", "cut", "middle", "rests")
    # A struct is an equal key for null ids too, so the join keeps the partitioning of the groups.
    key = F.struct("doc_id", "th").alias("key")
    texts = found.groupBy(key).agg(F.array_sort(F.collect_set(chunk_ids)).alias("parts"), F.count("*").alias("n"))

    def path(part: Column, k: Column) -> Column:
        head = F.get("heads", k)
        return F.when(part["cut"], F.concat(head, part["middle"], F.get(part["rests"], F.get("states", k)))).otherwise(head)

    joined = texts.join(states.select(key, "states", "heads"), "key").select(
        "key.doc_id", "key.th", F.flatten(F.transform("parts", path)).alias("ids"),
        F.explode(F.expr("sequence(1, cast(n / size(parts) as int))")).alias("_copy"),
    )
    long = joined.select("doc_id", "th", "ids")
    return short.union(long)


def piece_bytes(model: dict) -> list[bytes]:
    """The UTF-8 bytes that each id stands for."""
    raw = [n.encode() for n in model["names"]]
    for b, i in enumerate(model["byte_ids"]):
        raw[i] = bytes([b])
    return raw


def text_of(ids: list[int], raw: list[bytes]) -> str:
    return b"".join(map(raw.__getitem__, ids)).decode("utf-8", "replace").replace(BLANK, " ")[1:]


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` with the decoded text."""
    sent = encoded.sparkSession.sparkContext.broadcast(piece_bytes(load(path)))
    names = encoded.columns
    at = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = sent.value
        for batch in batches:
            rows, ids = batch.column(at).offsets.to_numpy(), batch.column(at).values.to_numpy()
            texts = pa.array([text_of(ids[a:b].tolist(), raw) for a, b in zip(rows[:-1], rows[1:])], pa.string())
            yield pa.record_batch([*batch.columns, texts], names=[*names, "decoded"])

    return encoded.mapInArrow(run, encoded.withColumn("decoded", F.lit("")).schema)


def with_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """Per document: number of pieces, hash of the ids, and whether they decode to the text."""
    found = decode(encode(docs, id_col, text_col, path, chunk), path)
    return found.select(
        "doc_id", "th", F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.char_length("decoded").cast("long").alias("decoded_chars"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.xxhash64("decoded") == F.col("th")).alias("round_trip"),
    )


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = MODEL) -> DataFrame:
    """(doc_id, ids, n_pieces, text_sha256): the token ids, and the digest of what they decode to."""
    found = decode(encode(docs, id_col, text_col, path), path)
    return found.select(
        F.col("doc_id").alias(id_col), "ids", F.size("ids").cast("long").alias("n_pieces"), F.sha2("decoded", 256).alias("text_sha256")
    )


@query("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document and what they decode to."""
    return with_pieces(table(spark, sf_dir, "documents")).drop("th")
