"""Alignment of two tokenizers over a corpus: where their tokens end together, and which ids overlap how often.

Tokenizer A is a byte-level BPE file, B a SentencePiece file. A text with a blank in front is cut by both;
positions at which a token of each ends cut it into groups, and an A and a B token whose bytes
overlap are linked. Everything behind the tokenizers is Arrow: token ids are flattened lists with parent
indices, ends are cumulative sums within a document, and one full outer Acero hash join of the two tables of
ends (key: the end within its document, as a place in the batch) gives all places where a token ends. The stretch
before each belongs to one token of each side, found by filling backwards, so the joined rows
are the links, and rows of both sides are the ends of groups. Groups are byte strings of their links;
dictionary encoding finds the distinct ones.

How often an id pair is linked in the corpus is a number per pair that every document needs. Documents are
gathered into blocks of about ``BLOCK`` bytes of text: a block counts its pairs with ``Table.group_by``, Spark adds
the counts up, and each block is told the totals of its own pairs once, instead of each document of its own. A
document keeps only the numbers of its groups (compressed), which its block turns into sums. No table of
pairs is broadcast by hand, and a block is one task group of bounded size; a longer document is a block.

Texts are tokenized in slices of ``SLICE`` bytes; a longer text is tokenized whole, and its tokens go
through the joins in pieces that end with a group.

Defined results: a text that is null, empty or whose joined tokens of either side differ from blank and text
(U+2581, normalised characters) has no tokens: zeros and an empty digest; strings of special tokens are plain text;
every row, repeated or without an id, gives a row; an empty table gives no rows; other columns are not read.
"""

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .registry import query, table
from .textbytes import slices

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK = 12 << 20  # bytes of text whose documents learn totals together
SLICE = 1 << 20  # bytes of text joined at a time
# Fixed value: how byte-level BPE files of this kind cut a text before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = np.uint32(1 << 31)  # marks a token that ends with its link


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level files: printable ones for themselves, others from 256 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokenizer:
    """Ids of a byte-level BPE file. Where ids follow the order of merges, ranks alone decide, which is faster."""

    def __init__(self, file: bytes):
        import tiktoken

        self.file, self.slow = file, None
        spec = json.loads(file)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        added = {t["id"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if i not in added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ordered = all(vocab[a + b] == 256 + i for i, (a, b) in enumerate(merges)) and len(ranks) == 256 + len(merges)
        self.fast = tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}) if ordered else None
        size = max(ranks.values(), default=-1) + 1
        self.tokens = [b""] * size
        for token, i in ranks.items():
            self.tokens[i] = token

    def ids(self, text: str) -> np.ndarray:
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # the pattern gives up on very long runs of white space
                pass
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_str(self.file.decode())
            self.slow.encode_special_tokens = True
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


class PieceTokenizer:
    """Ids of a SentencePiece file, which puts the blank in front itself."""

    def __init__(self, file: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        self.tokens = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.tokens.append(bytes([int(piece[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.tokens.append(b"")
            else:
                self.tokens.append(piece.replace("▁", " ").encode())

    def ids(self, text: str) -> np.ndarray:
        return self.model.encode_as_numpy(text)


@lru_cache(2)
def loaded(a: bytes, b: bytes) -> tuple["Side", "Side"]:
    return Side(ByteTokenizer(a)), Side(PieceTokenizer(b))


class Side:
    """A tokenizer with the bytes and lengths of its tokens as Arrow arrays."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.bytes = pa.array(tokenizer.tokens, pa.binary())
        self.lengths = pc.binary_length(self.bytes).cast(pa.int64())

    def encode(self, texts: list[str]) -> pa.LargeListArray:
        """A list of ids per text; a text whose tokens do not join to ``wanted`` has an empty list."""
        ids = [self.tokenizer.ids(t) for t in texts]
        at = np.append(0, np.cumsum([len(i) for i in ids], dtype=np.int64))
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        return pa.LargeListArray.from_arrays(at, pa.array(flat))

    def joins(self, lists: pa.LargeListArray, wanted: list[bytes]) -> np.ndarray:
        """Which texts the bytes of the tokens join to (and no token is empty)."""
        out = np.zeros(len(wanted), bool)
        for i, text in enumerate(wanted):
            ids = lists[i].values
            if pc.sum(pc.take(self.lengths, ids)).as_py() == len(text) and pc.min(pc.take(self.lengths, ids)).as_py():
                taken = pc.take(self.bytes, ids)
                _, offsets, data = taken.buffers()
                first, last = np.frombuffer(offsets, np.int32, 1, taken.offset * 4)[0], np.frombuffer(offsets, np.int32, 1, (taken.offset + len(taken)) * 4)[0]
                out[i] = memoryview(data).cast("B")[first:last] == text
        return out


def ends_of(side: Side, lists: pa.LargeListArray, starts: np.ndarray) -> pa.Table:
    """(end, id, row): every token's end, as a place in the batch whose documents begin at ``starts``."""
    parents, ids = lists.value_parent_indices(), lists.flatten()
    total = pc.cumulative_sum(pc.take(side.lengths, ids))
    # Sums within a document: less what came before its first token, plus where the document begins.
    offsets = lists.offsets.to_numpy()
    sums = np.append(0, total.to_numpy())
    within = pc.subtract(total, pa.array(sums[offsets[:-1]]).take(parents))
    return pa.table({"end": pc.add(within, pa.array(starts).take(parents)), "id": ids})


def pieces(a: pa.Table, b: pa.Table, size: int) -> Iterator[tuple[pa.Table, pa.Table]]:
    """The two tables of ends, cut behind common ends about every ``size`` bytes."""
    ea, eb = a["end"].to_numpy(), b["end"].to_numpy()
    if not len(ea):
        return
    cuts = np.array([ea[-1]])
    if ea[-1] - ea[0] > 2 * size:
        common = np.intersect1d(ea, eb, assume_unique=True)
        cuts = np.unique(common[np.searchsorted(common, np.append(np.arange(ea[0] + size, ea[-1], size), ea[-1]))])
    i = j = 0
    for cut in cuts:
        x, y = int(np.searchsorted(ea, cut, "right")), int(np.searchsorted(eb, cut, "right"))
        yield a.slice(i, x - i), b.slice(j, y - j)
        i, j = x, y


def links(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends in order, and the ids of the tokens that reach to each; an id is marked where its token ends there."""
    left = pa.table({"end": a["end"], "a": a["id"]})
    right = pa.table({"end": b["end"], "b": b["id"]})
    both = left.join(right, keys="end", join_type="full outer", use_threads=False).combine_chunks()
    both = both.take(pc.sort_indices(both["end"])).combine_chunks()
    out = []
    for name in ("a", "b"):
        column = both[name].combine_chunks()
        filled = pc.fill_null_backward(column).to_numpy(zero_copy_only=False).astype(np.uint32)
        out.append(filled | np.where(column.is_valid().to_numpy(zero_copy_only=False), END, np.uint32(0)))
    return both["end"].to_numpy(), out[0], out[1]


def groups(a: np.ndarray, b: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Groups as bytes of their links, dictionary encoded, and the row of each group's last link."""
    last = np.flatnonzero(a & b & END)
    rows = np.empty((len(a), 2), "<u4")
    rows[:, 0], rows[:, 1] = a, b
    offsets = np.append(0, (last + 1) * 8).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_binary(), len(last), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])
    return array.dictionary_encode(), last


def spelled(distinct: pa.LargeBinaryArray) -> pa.Array:
    """``a1,a2|b1`` for each distinct group."""
    _, offsets, data = distinct.buffers()
    at = np.frombuffer(offsets, np.int64, len(distinct) + 1, distinct.offset * 8) // 8
    rows = np.frombuffer(data, "<u4").reshape(-1, 2)[at[0] : at[-1]]
    at, sides = at - at[0], []
    for column in rows.T:
        ends = (column & END) > 0
        before = np.append(0, np.cumsum(ends))
        names = pa.array((column[ends] & ~END).astype(np.int32)).cast(pa.string())
        sides.append(pc.binary_join(pa.ListArray.from_arrays(before[at].astype(np.int32), names), ","))
    return pc.binary_join_element_wise(*sides, "|")


class Document:
    """What a block holds of a document until it is complete."""

    def __init__(self, doc_id):
        self.doc_id, self.a, self.b, self.links = doc_id, 0, 0, 0
        self.parts: list[tuple[int, int, int]] = []  # piece of the block, first and last group in it
        self.digest = None


OUT = "block string, doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, kinds binary, a array<int>, b array<int>, n array<long>, sizes binary, pairs binary"


class Block:
    """Documents with their groups, numbered within the block."""

    def __init__(self, name: str):
        self.name, self.documents, self.encoded, self.size = name, [], [], 0

    def add(self, doc_ids: list, texts: list, sides: tuple[Side, Side], size: int) -> None:
        """Documents of one slice."""
        made = [Document(i) for i in doc_ids]
        self.documents += made
        full = [(d, t) for d, t in zip(made, texts) if t]
        if not full:
            return
        wanted = [b" " + t.encode() for _, t in full]
        la, lb = sides[0].encode([" " + t for _, t in full]), sides[1].encode([t for _, t in full])
        good = np.flatnonzero(sides[0].joins(la, wanted) & sides[1].joins(lb, wanted))
        if not len(good):
            return
        la, lb = (x.take(pa.array(good)) for x in (la, lb))
        made, lengths = [full[i][0] for i in good], np.array([len(wanted[i]) for i in good])
        stops = np.cumsum(lengths)
        self.size += int(stops[-1])
        for d, x, y in zip(made, np.diff(la.offsets.to_numpy()), np.diff(lb.offsets.to_numpy())):
            d.a, d.b, d.digest = int(x), int(y), hashlib.sha256()
        for a, b in pieces(ends_of(sides[0], la, stops - lengths), ends_of(sides[1], lb, stops - lengths), size):
            self.piece(*links(a, b), made, stops)

    def piece(self, end: np.ndarray, a: np.ndarray, b: np.ndarray, made: list[Document], stops: np.ndarray) -> None:
        """Links of whole groups: one slice of documents, or a part of one."""
        encoded, last = groups(a, b)
        names = spelled(encoded.dictionary).take(encoded.indices)
        cuts = np.searchsorted(end[last], stops, "right")  # groups that end up to each document's end
        rows = np.append(0, last + 1)
        for i in range(int(np.searchsorted(stops, end[0])), int(np.searchsorted(stops, end[-1])) + 1):
            lo, hi = int(cuts[i - 1]) if i else 0, int(cuts[i])
            d = made[i]
            if d.parts:
                d.digest.update(b";")
            text = pc.binary_join(pa.ListArray.from_arrays([0, hi - lo], names[lo:hi]), ";")
            d.digest.update(text[0].as_buffer())
            d.parts.append((len(self.encoded), lo, hi))
            d.links += int(rows[hi] - rows[lo])
        self.encoded.append(encoded)

    def rows(self) -> list[dict]:
        """Rows of ``OUT``: the documents, and one row with the pairs of the block."""
        numbers, own = [], {}
        if self.encoded:
            chunks = pa.chunked_array(self.encoded).unify_dictionaries().chunks
            numbers = [c.indices.to_numpy() for c in chunks]
            distinct = chunks[0].dictionary
            count = np.zeros(len(distinct), np.int64)
            for n in numbers:
                count += np.bincount(n, minlength=len(count))
            _, offsets, data = distinct.buffers()
            at = np.frombuffer(offsets, np.int64, len(distinct) + 1, distinct.offset * 8) // 8
            ids = (np.frombuffer(data, "<u4").reshape(-1, 2)[at[0] : at[-1]] & ~END).astype(np.int64)
            pair = pa.array(ids[:, 0] << 32 | ids[:, 1]).dictionary_encode()
            linked = pa.table({"pair": pair.indices, "n": np.repeat(count, np.diff(at))}).group_by("pair").aggregate([("n", "sum")]).sort_by("pair")
            names = pair.dictionary.to_numpy()
            own = {
                "a": (names >> 32).astype(np.int32), "b": (names & 0xFFFFFFFF).astype(np.int32), "n": linked["n_sum"].to_numpy(),
                "sizes": packed(np.diff(at)), "pairs": packed(pair.indices.to_numpy()),
            }
        out = []
        for d in self.documents:
            kinds = np.concatenate([numbers[p][lo:hi] for p, lo, hi in d.parts]) if d.parts else np.zeros(0, np.int32)
            digest = d.digest.hexdigest() if d.parts else ""
            out.append({"block": self.name, "doc_id": d.doc_id, "n_a": d.a, "n_b": d.b, "n_groups": len(kinds), "n_links": d.links, "groups_sha256": digest, "kinds": packed(kinds)})
        if own:
            out.append({"block": self.name, **own})
        return out


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, compressed, with their count in front."""
    raw = numbers.astype("<u4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd"), "<u4") if size else np.zeros(0, "<u4")


def aligned(docs: DataFrame, id_col: str, text_col: str, byte_model: str, piece_model: str, block: int, size: int) -> DataFrame:
    """Rows of ``OUT``."""
    with open(byte_model, "rb") as a, open(piece_model, "rb") as b:
        sent = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    schema = OUT.format(docs.schema[id_col].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        sides, now = loaded(*sent.value), Block(uuid.uuid4().hex)
        kind = None

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, arrow)

        for batch in batches:
            if kind is None:
                kind = batch.schema.field(0).type
                ints = pa.list_(pa.int32())
                arrow = pa.schema(
                    [("block", pa.string()), ("doc_id", kind), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()),
                     ("kinds", pa.binary()), ("a", ints), ("b", ints), ("n", pa.list_(pa.int64())), ("sizes", pa.binary()), ("pairs", pa.binary())]
                )
            for part in slices(batch, 1, size):
                now.add(part.column(0).to_pylist(), part.column(1).to_pylist(), sides, size)
                if now.size >= block:
                    yield out(now.rows())
                    now = Block(uuid.uuid4().hex)
        if now.documents:
            yield out(now.rows())

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, n, best): links of every id pair in the corpus, and whether none of its B id has more."""
    some = blocks.filter(F.col("a").isNotNull()).select(F.explode(F.arrays_zip("a", "b", "n")).alias("x"))
    totals = settle(some.groupBy("x.a", "x.b").agg(F.sum("x.n").alias("n")), "pairs")
    most = totals.groupBy("b").agg(F.max("n").alias("most"))
    return totals.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL,
    block: int = BLOCK, size: int = SLICE,
) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) and pairs (a, b, n, best)."""
    blocks = settle(aligned(docs, id_col, text_col, byte_model, piece_model, block, size), "aligned")
    counts = settle(pair_counts(blocks), "counts")
    wanted = blocks.filter(F.col("a").isNotNull()).select("block", F.posexplode(F.arrays_zip("a", "b")).alias("place", "x"))
    told = wanted.select("block", "place", "x.a", "x.b").join(counts, ["a", "b"]).select(F.col("block").alias("home"), "place", "n", "best")
    mine = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "kinds", "sizes", "pairs")

    def sums(documents: pa.Table, totals: pa.Table) -> pa.Table:
        own = documents.filter(pc.is_valid(documents["sizes"]))
        rest = documents.filter(pc.is_null(documents["sizes"]))
        best, total = [0] * rest.num_rows, [0] * rest.num_rows
        if own.num_rows:
            order = pc.sort_indices(totals["place"])
            n = totals["n"].take(order).to_numpy()
            top = totals["best"].take(order).to_numpy().astype(np.int64)
            sizes, pairs = unpacked(own["sizes"][0].as_py()), unpacked(own["pairs"][0].as_py())
            at = np.append(0, np.cumsum(sizes[:-1], dtype=np.int64))
            per_kind = np.add.reduceat(n[pairs], at), np.add.reduceat(top[pairs], at)
            for i, kinds in enumerate(rest["kinds"]):
                kinds = unpacked(kinds.as_py())
                total[i], best[i] = int(per_kind[0][kinds].sum()), int(per_kind[1][kinds].sum())
        plain = [rest[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table(
            [*plain, pa.array(best, pa.int64()), pa.array(total, pa.int64()), rest["groups_sha256"]],
            names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return mine.groupBy("block").cogroup(told.groupBy("home")).applyInArrow(sums, schema), counts


@query("op13_tokenizer_alignment")
def op13(spark, sf_dir):
    """Groups and links of the two tokenizers in every document."""
    return align(table(spark, sf_dir, "documents"))[0]
