"""Alignment of two tokenizers' tokens over the same bytes, by tokenizer spans.

A is a byte-level BPE of the `tokenizers` library, B a SentencePiece model with byte
fallback. Both see the text with one space in front, which B adds itself. Their spans (A's
character offsets, B's proto spans) give coarse cuts: places where tokens of both end
between two characters. Between coarse cuts, where a character of several bytes is shared by
several tokens, and for byte-fallback tokens, the tokens' decoded bytes give the exact place.
Groups end where tokens of both end; tokens whose bytes overlap are linked.

Neither tokenizer lets a token, or a merge, reach from a character that is not white space
over a single space into the next word. So a text is cut there into chunks (a word with the
space before it), each distinct chunk of a block is aligned once, and a text's alignment is
that of its chunks, one after the other. Many chunks are aligned together as arrays.

1. Blocks of about `BLOCK_BYTES` of text are aligned. A block becomes one row: its documents
   as lists of chunk numbers, its chunks as lists of pair numbers, its distinct pairs of ids
   and how many links each has. It is written, so tokenizers run once.
2. Counts of pairs are summed over all blocks, with map-side combine; the highest count of
   each B id is a table of at most one row per id of B's vocabulary.
3. Pairs of a block get their corpus-wide counts, return to the block by its number, and
   are added up per document.

Nothing grows with the corpus in any task or on the driver: a block's pairs are bounded by
its bytes (one text is never cut, so a block holds a text at least), and only the table by B
id, bounded by the vocabulary, may be broadcast.

Defined results: a null or empty text has no tokens, nor has one whose tokens' bytes do not
give back the space and the text (as with a whitespace marker in the text): zeros and an
empty `groups_sha256`. Strings of special tokens are plain text. Rows that repeat count each
time; a null id is carried like any other. An empty table gives an empty result. Only id and
text are read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import few_at_a_time, numbered_blocks, pack, text_or_empty, unpack, written

BLOCK_BYTES = 8_000_000
# Characters of new chunks that the tokenizers get at once.
AT_ONCE = 200_000
# Chunks that the tokenizers get as one text.
TOGETHER = 64
MARKER = "▁"
# How a SentencePiece model writes the piece of a single byte.
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """Character by which byte-level vocabularies write each byte: printable Latin-1
    characters stand for themselves, the other bytes in order for those from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


@dataclass
class Tokens:
    """Tokens of chunks that stand one after the other: `ids`, the number `n` of each chunk,
    the characters at which each token starts and ends by its tokenizer, `size` in bytes."""

    ids: np.ndarray
    n: np.ndarray
    start: np.ndarray
    end: np.ndarray
    size: np.ndarray

    def of(self, chunks: np.ndarray) -> Tokens:
        """The tokens of some chunks, spans as they were."""
        own = np.repeat(chunks, self.n)
        return Tokens(self.ids[own], self.n[chunks], self.start[own], self.end[own], self.size[own])


def byte_ends(tokens: Tokens, chars: np.ndarray, byte_at: np.ndarray) -> np.ndarray:
    """Byte at which each token ends. `chars` is where each chunk ends in characters, and
    `byte_at` gives the byte of a character.

    Where a token ends and the next one starts behind it, the span is a coarse cut. Tokens
    that share a character with the next one end as many bytes behind the last cut as the
    decoded bytes since then.
    """
    last = np.cumsum(tokens.n) - 1
    start, end = tokens.start.copy(), tokens.end.copy()
    end[last] = chars
    # Of the bytes of a character only the last one has a span; it is that of all of them.
    spread = np.where(start < end, np.arange(len(end)), len(end) - 1)
    end = end[np.minimum.accumulate(spread[::-1])[::-1]]
    cut = np.ones(len(end), dtype=bool)
    cut[:-1] = start[1:] >= end[:-1]
    cut[last] = True
    decoded = np.cumsum(tokens.size)
    ahead = np.where(cut, byte_at[end] - decoded, 0)
    before = np.maximum.accumulate(np.where(cut, np.arange(len(end)), -1))
    return decoded + np.where(before >= 0, ahead[before], 0)


@dataclass
class Aligned:
    """Alignment of chunks: tokens of both and groups of each, the groups as text with a
    semicolon behind each, the ids joined by its links (A's id in the upper half)."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[str]
    n_links: np.ndarray
    pairs: np.ndarray


class Aligner:
    """Both tokenizers and tables of their vocabularies."""

    def __init__(self, byte_bpe: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = tokenizers.Tokenizer.from_str(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        alphabet = byte_alphabet()
        size = self.a.get_vocab_size()
        self.a_bytes = [
            bytes(alphabet.get(c, 0x3F) for c in self.a.id_to_token(i) or "") for i in range(size)
        ]
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (
            np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes)
        )
        # How ids are written in groups: within a side, at the end of a side.
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.written = [f"{i}{sign}" for sign in ",|;" for i in range(most)]
        self.written_size = np.array([len(w) for w in self.written], np.int64)
        self.most = most

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        byte = BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
        return bytes([int(byte[1], 16)]) if byte else piece.replace(MARKER, " ").encode()

    def _tokens(self, chunks: list[str]) -> tuple[Tokens, Tokens]:
        """Tokens of both. Chunks that begin and end with other than white space can stand in
        one text, as they do in theirs, so `TOGETHER` of them go to the tokenizers at once."""
        texts: list[str] = []
        held: list[str] = []
        for chunk in chunks:
            alone = chunk[0].isspace() or chunk[-1].isspace()
            if held and (alone or len(held) == TOGETHER):
                texts.append(" ".join(held))
                held = []
            if alone:
                texts.append(chunk)
            else:
                held.append(chunk)
        if held:
            texts.append(" ".join(held))
        base = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        begins = np.cumsum([0, *(len(c) + 1 for c in chunks)])
        encodings = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        spans = self.b.encode(texts, return_type="offset_mapping", num_threads=1)
        out = []
        for ids, offsets, sizes, ahead in (
            ([e.ids for e in encodings], [e.offsets for e in encodings], self.a_size, 0),
            # B leaves out the space in front.
            ([s["ids"] for s in spans], [s["offsets"] for s in spans], self.b_size, 1),
        ):
            shift = np.repeat(base + ahead, [len(i) for i in ids])
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            places = np.fromiter(chain.from_iterable(chain.from_iterable(offsets)), np.int64).reshape(-1, 2)
            start, end = places[:, 0] + shift, places[:, 1] + shift
            n = np.diff(np.searchsorted(start, begins))
            out.append(Tokens(flat, n, start, end, sizes[flat]))
        return out[0], out[1]

    def _given_back(self, tokens: Tokens, table: list[bytes], chunks: list[str]) -> np.ndarray:
        """Whether the tokens' bytes are a space and the chunk."""
        if b"".join(map(table.__getitem__, tokens.ids.tolist())) == "".join([" " + c for c in chunks]).encode():
            lengths = np.array([len(c.encode()) + 1 for c in chunks])
            sizes = np.add.reduceat(tokens.size, np.cumsum(tokens.n) - tokens.n) if tokens.n.all() else lengths - 1
            if np.array_equal(sizes, lengths):
                return np.ones(len(chunks), dtype=bool)
        parts = np.split(tokens.ids, np.cumsum(tokens.n)[:-1])
        return np.array([
            b"".join([table[i] for i in ids.tolist()]) == (" " + c).encode() for ids, c in zip(parts, chunks)
        ])

    def align(self, chunks: list[str]) -> tuple[np.ndarray, Aligned]:
        """Which chunks both tokenizers give back, and the alignment of those."""
        # B takes a marker for a space, so no chunk with one is given back.
        fine = np.array([MARKER not in c for c in chunks], dtype=bool)
        chunks = [c for c, f in zip(chunks, fine) if f]
        own: list[str] = []
        if chunks:
            a, b = self._tokens(chunks)
            back = self._given_back(a, self.a_bytes, chunks) & self._given_back(b, self.b_bytes, chunks)
            own = [c for c, f in zip(chunks, back) if f]
            fine[fine] = back
        if not own:
            none = np.zeros(0, np.int64)
            return fine, Aligned(none, none, none, [], none, none)
        if len(own) < len(chunks):
            gone = np.array([0 if f else len(c) + 1 for c, f in zip(chunks, back)])
            moved = np.cumsum(gone)
            for tokens in (a, b):
                shift = np.repeat(moved, tokens.n)
                tokens.start, tokens.end = tokens.start - shift, tokens.end - shift
            a, b = a.of(back), b.of(back)
        text = "".join([" " + c for c in own])
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        widths = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF).astype(np.int64)
        byte_at = np.concatenate([[0], np.cumsum(widths)])
        chars = np.cumsum([len(c) + 1 for c in own])
        return fine, self._joined(a, b, byte_ends(a, chars, byte_at), byte_ends(b, chars, byte_at), byte_at[chars])

    def _joined(self, a: Tokens, b: Tokens, a_ends, b_ends, stops: np.ndarray) -> Aligned:
        """Alignment of tokens that end at these bytes, in chunks that end at `stops`."""
        # Between two ends of any kind lies one token of each: a link.
        ends = np.union1d(a_ends, b_ends)
        in_a, in_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        pairs = (a.ids[in_a] << 32) | b.ids[in_b]
        both = (a_ends[in_a] == ends) & (b_ends[in_b] == ends)
        cuts = ends[both]
        # Ids in the order of the groups: A's, then B's, of each.
        group = np.concatenate([np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)])
        order = np.argsort(2 * group + (np.arange(len(group)) >= len(a_ends)), kind="stable")
        closing = np.concatenate([np.isin(a_ends, cuts) * self.most, np.isin(b_ends, cuts) * 2 * self.most])
        codes = (np.concatenate([a.ids, b.ids]) + closing)[order]
        text = "".join(map(self.written.__getitem__, codes.tolist()))
        places = np.concatenate([[0], np.cumsum(self.written_size[codes])])
        bounds = [0, *places[np.cumsum(a.n + b.n)].tolist()]
        counts = np.diff(np.concatenate([[0], np.searchsorted(cuts, stops, "right")]))
        links = np.diff(np.concatenate([[0], np.searchsorted(ends, stops, "right")]))
        return Aligned(a.n, b.n, counts, [text[x:y] for x, y in zip(bounds, bounds[1:])], links, pairs)


def chunks_of(text: str) -> list[str]:
    """Pieces of a text between single spaces that stand between other characters."""
    return _CUT.split(text) if text else []


def _ragged(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


class _Block:
    """What is gathered of one block of texts: its distinct chunks, and the numbers of the
    chunks of each text."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.numbers: dict[str, int] = {}
        self.waiting: list[str] = []
        self.chars = 0
        self.fine: list[np.ndarray] = []
        self.parts: list[Aligned] = []
        self.ids: list = []
        self.texts: list[np.ndarray] = []

    def add(self, doc_id, text: str) -> None:
        numbers, own = self.numbers, []
        for chunk in chunks_of(text):
            number = numbers.get(chunk)
            if number is None:
                number = numbers[chunk] = len(numbers)
                self.waiting.append(chunk)
                self.chars += len(chunk)
            own.append(number)
        self.ids.append(doc_id)
        self.texts.append(np.array(own, np.int32))
        if self.chars >= AT_ONCE:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            fine, part = self.aligner.align(self.waiting)
            self.fine.append(fine)
            self.parts.append(part)
            self.waiting, self.chars = [], 0

    def record(self, block: int, id_type: pa.DataType) -> pa.RecordBatch:
        self.flush()
        none = np.zeros(0, np.int64)
        fine = np.concatenate([none, *self.fine]).astype(bool)

        def whole(name: str) -> np.ndarray:
            """A number of every chunk, 0 for those without tokens."""
            out = np.zeros(len(fine), np.int64)
            out[fine] = np.concatenate([none, *(getattr(p, name) for p in self.parts)])
            return out

        groups = np.full(len(fine), "", dtype=object)
        groups[fine] = [g for p in self.parts for g in p.groups]
        n_links = whole("n_links")
        flat = np.concatenate([none, *(p.pairs for p in self.parts)])
        # A text with a chunk that is not given back has no tokens at all.
        texts = [t if fine[t].all() else t[:0] for t in self.texts]
        used, lengths = np.concatenate([np.zeros(0, np.int32), *texts]), np.array([len(t) for t in texts], np.int64)
        times = np.bincount(used, minlength=len(fine))
        pairs, place = np.unique(flat, return_inverse=True)
        counts = np.bincount(
            place, weights=np.repeat(times, n_links), minlength=len(pairs)
        ).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(lengths)])

        def summed(values: np.ndarray) -> pa.Array:
            total = np.concatenate([[0], np.cumsum(values[used])]).astype(np.int64)
            return pa.array(total[bounds[1:]] - total[bounds[:-1]])

        digests = [
            hashlib.sha256("".join(groups[t])[:-1].encode()).hexdigest() if len(t) else "" for t in texts
        ]
        docs = pa.table(
            [pa.array(self.ids, id_type), summed(whole("n_a")), summed(whole("n_b")),
             summed(whole("n_groups")), summed(n_links), pa.array(digests, pa.string()),
             _ragged(used, lengths)],
            ["id", "n_a", "n_b", "n_groups", "n_links", "sha", "chunks"],
        )
        own = pa.table([_ragged(place, n_links)], ["pairs"])
        # Pairs of chunks that only texts without tokens hold are in no link.
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([pack(docs)], pa.binary()), pa.array([pack(own)], pa.binary()),
             pa.array([pairs], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))],
            ["block", "docs", "chunks", "pairs", "times"],
        )


def aligned_blocks(texts: DataFrame, byte_bpe: str, piece_model: bytes) -> DataFrame:
    """One row per block of texts (id, text): `docs`, `chunks` packed, `pairs`, `times`."""
    shared = texts.sparkSession.sparkContext.broadcast((byte_bpe, piece_model))
    block_bytes = BLOCK_BYTES

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for number, rows in numbered_blocks(batches, block_bytes):
            if aligner is None:
                aligner = Aligner(*shared.value)
            block, id_type = _Block(aligner), rows[0].schema.field(0).type
            for batch in few_at_a_time(rows):
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    block.add(doc_id, text)
            yield block.record(number, id_type)

    return texts.mapInArrow(
        aligned, "block long, docs binary, chunks binary, pairs array<long>, times array<long>"
    )


def pair_counts(blocks: DataFrame) -> DataFrame:
    """`pair`, `links` in the whole corpus, and `best` (1 if no pair of its B id has more)."""
    rows = blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).filter("x.times > 0")
    counts = written(
        rows.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("links")), "pair_counts"
    )
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    # At most one row per id of B's vocabulary.
    highest = counts.groupBy(b_id.alias("_b")).agg(F.max("links").alias("_most"))
    return counts.join(F.broadcast(highest), b_id == F.col("_b")).select(
        "pair", "links", (F.col("links") == F.col("_most")).alias("best")
    )


def _per_document(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block with the sums over their links."""
    out = []
    order = np.argsort(np.asarray(counts.column("place")), kind="stable")
    links = np.asarray(counts.column("links"))[order].astype(np.int64)
    best = np.asarray(counts.column("best"))[order].astype(np.int64)
    for docs, chunks in zip(blocks.column("docs"), blocks.column("chunks")):
        docs, chunks = unpack(docs.as_py()), unpack(chunks.as_py()).column("pairs").combine_chunks()
        place, size = np.asarray(chunks.flatten()), np.asarray(pc.list_value_length(chunks)).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)

        def summed(values: np.ndarray, ends: np.ndarray = ends, place: np.ndarray = place) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values[place])]).astype(np.int64)
            return total[ends[1:]] - total[ends[:-1]]

        used = docs.column("chunks").combine_chunks()
        own, n = np.asarray(used.flatten()), np.asarray(pc.list_value_length(used)).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        docs = docs.drop_columns(["chunks"])
        docs = docs.append_column("n_best", pa.array(summed(summed(best), bounds, own)))
        docs = docs.append_column("count_sum", pa.array(summed(summed(links), bounds, own)))
        out.append(docs)
    return pa.concat_tables(out)


def align(
    docs: DataFrame, byte_bpe: str, piece_model: bytes, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: its id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256. `byte_bpe` is the JSON text of A, `piece_model` the model file of B."""
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text).alias("_text"))
    blocks = written(aligned_blocks(texts, byte_bpe, piece_model), "aligned")
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    answered = asked.join(pair_counts(blocks), "pair").select(
        F.col("block").alias("_of"), "place", "links", "best"
    )
    id_type = texts.schema["id"].dataType.simpleString()
    out = (
        blocks.select("block", "docs", "chunks").groupBy("block").cogroup(answered.groupBy("_of"))
        .applyInArrow(
            _per_document,
            f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, sha string, "
            "n_best long, count_sum long",
        )
    )
    return out.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.col("sha").alias("groups_sha256"),
    )
