"""SentencePiece encoding and decoding through a table of distinct marked words.

The model replaces spaces by a marker, puts one before the text, and none of its pieces
has a marker after another character. So no piece and no merge reaches over the start of
a marker run, and a text's ids are those of its marked words (marker run and what follows)
one after the other. `check_model` makes sure that a model is of that kind.

1. The table is read in blocks of about `BLOCK_BYTES`. Each block gives its
   distinct marked words, dealt to buckets by a hash of the word.
2. A bucket gathers the words of all blocks; each distinct word is segmented, and its ids
   decoded, once. The results go back to the blocks that asked.
3. Each block meets its own part of the table and its texts, and ids are joined by
   position. A block's texts travel once, compressed.

Memory is bounded by the block and by the bucket, whose number grows with the text. Words
of a block are distinct, so a word in every text is one row per block. A word that a block
does not find, because a lost task was run again on differently cut input, is segmented on
the spot: results never depend on how the input is cut.

Defined results: a null text is empty, and an empty text has the end id only; the marker
character itself counts as a space, as in the library; rows that repeat are encoded alike;
an empty table gives an empty result. Only the id column is carried along.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import (
    few_at_a_time,
    numbered_blocks,
    pack_strings,
    packed_blocks,
    text_blocks,
    text_or_empty,
    total_bytes,
    unpack,
    unpack_strings,
)

MARKER = "▁"
BLOCK_BYTES = 24_000_000
# Text per bucket of the word table.
BUCKET_BYTES = 48 << 20

_RUN = re.compile(r" +[^ ]*")


def load(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_model(model: bytes) -> None:
    """Refuse a model whose pieces can cross the start of a marker run, or that changes
    texts before it segments them."""
    own = load(model)
    for i in range(own.get_piece_size()):
        piece = own.id_to_piece(i)
        if MARKER in piece.lstrip(MARKER):
            raise ValueError(f"piece {piece!r} crosses a whitespace marker")
    probe = "  A  ﬁ é"
    if own.decode(own.encode(probe)) != probe:
        raise ValueError("the model normalises texts or adds no marker in front")


def marked_words(text: str) -> list[str]:
    """Marked words of a text, each without its first marker and with spaces for the
    others; the library puts the first one back."""
    text = text.replace(MARKER, " ")
    if not text:
        return []
    if "  " in text or text[0] == " ":
        return [run[1:] for run in _RUN.findall(" " + text)]
    return text.split(" ")


def segment(own: sentencepiece.SentencePieceProcessor, words: list[str]) -> tuple[list[bytes], dict[str, str]]:
    """Ids of each word as 32-bit integers, and the decoded form of those words that do
    not decode to themselves."""
    alone = own.piece_to_id(MARKER)
    ids = own.encode(words, num_threads=1)
    ids = [i if w else [alone] for w, i in zip(words, ids)]
    back = own.decode(ids, num_threads=1)
    changed = {w: b for w, b in zip(words, back) if w != b}
    return [np.array(i, dtype="<i4").tobytes() for i in ids], changed


def dealt_words(texts: Iterable[str], buckets: int) -> list[list[bytes]]:
    """The distinct marked words of texts by bucket, sorted."""
    words: set[str] = set()
    for text in texts:
        words.update(marked_words(text))
    dealt: list[list[bytes]] = [[] for _ in range(buckets)]
    for word in words:
        raw = word.encode()
        dealt[zlib.crc32(raw) % buckets].append(raw)
    for own in dealt:
        own.sort()
    return dealt


def word_table(
    texts: DataFrame, model: bytes, buckets: int, block_bytes: int | None = None
) -> DataFrame:
    """For every block and bucket the ids of the block's distinct marked words, in the
    order of `dealt_words`, with the decoded form of words that decode to another. The
    words themselves do not travel back: the block knows them, and `check` tells whether
    they are the same."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    block_bytes = block_bytes or BLOCK_BYTES

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in numbered_blocks(batches, block_bytes):
            found = (t for batch in few_at_a_time(rows) for t in batch.column(1).to_pylist())
            for bucket, own in enumerate(dealt_words(found, buckets)):
                if own:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block]), pa.array([bucket], pa.int32()),
                         pa.array([pack_strings(own)], pa.binary())],
                        ["block", "bucket", "words"],
                    )

    def segmented(asked: pa.Table) -> pa.Table:
        own = load(shared.value)
        lists = [unpack_strings(w.as_py()) for w in asked.column("words")]
        distinct = sorted({w for words in lists for w in words})
        encoded, changed = segment(own, [w.decode() for w in distinct])
        ids = dict(zip(distinct, encoded))
        changed = {w.encode(): d.encode() for w, d in changed.items()}
        out: dict[str, list] = {"ids": [], "odd": [], "check": []}
        for words in lists:
            out["ids"].append(pack_strings([ids[w] for w in words]))
            odd = [w for w in words if w in changed]
            out["odd"].append(pack_strings([x for w in odd for x in (w, changed[w])]))
            out["check"].append(zlib.crc32(b" ".join(words)))
        return pa.table(
            {
                "block": asked.column("block"),
                "bucket": asked.column("bucket"),
                "ids": pa.array(out["ids"], pa.binary()),
                "odd": pa.array(out["odd"], pa.binary()),
                "check": pa.array(out["check"], pa.int64()),
            }
        )

    words = texts.mapInArrow(distinct_words, "block long, bucket int, words binary")
    return words.groupBy("bucket").applyInArrow(
        segmented, "block long, bucket int, ids binary, odd binary, check long"
    )


def encode(
    docs: DataFrame,
    model: bytes,
    id_col: str = "doc_id",
    text: str = "text",
    end: bool = True,
    block_bytes: int | None = None,
    bucket_bytes: int | None = None,
) -> DataFrame:
    """One row per document: its id, `ids` with the end id, and `decoded`, the text that
    the ids decode to. Smaller blocks and buckets than `BLOCK_BYTES` and `BUCKET_BYTES` take
    less memory and send more words; the result is the same."""
    check_model(model)
    block_bytes = block_bytes or BLOCK_BYTES
    texts = docs.select(id_col, text_or_empty(text).alias("_text"))
    buckets = text_blocks(total_bytes(texts, "_text"), bucket_bytes or BUCKET_BYTES)
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def assemble(blocks: pa.Table, table: pa.Table) -> Iterator[pa.RecordBatch]:
        own = load(shared.value)
        closing = np.array([own.eos_id()] if end else [], dtype="<i4").tobytes()
        ids: dict[str, bytes] = {}
        odd: dict[str, str] = {}
        texts = [unpack(packed.as_py()) for packed in blocks.column("packed")]
        slices = (b for part in texts for b in few_at_a_time(part.to_batches()))
        dealt = dealt_words((t for b in slices for t in b.column(1).to_pylist()), buckets)
        for row in table.select(["bucket", "ids", "odd", "check"]).to_pylist():
            words = dealt[row["bucket"]]
            if row["check"] == zlib.crc32(b" ".join(words)):
                ids.update(zip((w.decode() for w in words), unpack_strings(row["ids"])))
                changed = [x.decode() for x in unpack_strings(row["odd"])]
                odd.update(zip(changed[::2], changed[1::2]))
        del dealt
        while texts:
            for batch in few_at_a_time(texts.pop(0).to_batches()):
                yield _joined(batch, ids, odd, closing, own)

    def _joined(batch, ids, odd, closing, own) -> pa.RecordBatch:
        found, decoded = [], []
        for one in batch.column(1).to_pylist():
            words = marked_words(one)
            missing = [w for w in set(words) if w not in ids]
            if missing:
                encoded, changed = segment(own, missing)
                ids.update(zip(missing, encoded))
                odd.update(changed)
            found.append(b"".join([ids[w] for w in words]) + closing)
            decoded.append(" ".join([odd.get(w, w) for w in words] if odd else words))
        offsets = np.cumsum([0, *(len(f) // 4 for f in found)], dtype=np.int32)
        values = pa.array(np.frombuffer(b"".join(found), dtype="<i4"), pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), values),
             pa.array(decoded, pa.string())],
            [id_col, "ids", "decoded"],
        )

    def whole(blocks: pa.Table, table: pa.Table) -> pa.Table:
        batches = list(assemble(blocks, table))
        if not batches:
            return pa.table(
                [blocks.schema.empty_table().column("block"), pa.array([], pa.list_(pa.int32())),
                 pa.array([], pa.string())], [id_col, "ids", "decoded"])
        return pa.Table.from_batches(batches)

    table = word_table(texts, model, buckets, block_bytes)
    return (
        packed_blocks(texts, block_bytes).groupBy("block").cogroup(table.groupBy("block"))
        .applyInArrow(whole, f"`{id_col}` {id_type}, ids array<int>, decoded string")
    )
