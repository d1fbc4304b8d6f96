"""Language-model scores from a hierarchical Pitman-Yor model.

Restaurants, from the most specific to the most general:

* one per context, which is any word seen in the learnt texts, or the start of a text: its
  customers are the tokens that follow it;
* the root, shared by all of them: its customers are the tables of all context restaurants;
* spelling, the base of the root: each root table spells its word, byte by byte and with a
  closing symbol, in restaurants of two preceding symbols, which share parents of one
  symbol, of none, and the uniform distribution. Words that were never learnt are one kind
  of token, with the mass that spelling leaves to all of them together.

Seating is sampled by Gibbs sweeps (see `seating`). Given an auxiliary variable of each
context and drawn masses of the root's words, the tables of all pairs of context and word are
independent, so pairs are dealt to buckets by a hash of both: no frequent word or context
meets in one task. A sweep is two exchanges. A word bucket sums the tables that pairs report
for its words, as contexts and as words, seats the root, and draws the variables; a pair
bucket draws its tables from them. Pairs seen once always have one table, and are reported
once. Two things are means instead of draws: what words get from the share of the root that is
on no table, and the spelling, which is one sweep old. The predictive probabilities of
`SAMPLES` sweeps after `BURN_IN` are averaged.

Texts are split once. A block becomes numbers of its own words; word buckets answer with
the words' places and counts, later with their probabilities, pair buckets with counts and
tables of the block's pairs. The tables of words and pairs are never on the driver; the
spelling model is, and is broadcast: it has at most 258 * 258 * 257 entries.

Defined results: a null text is empty; an empty text has its end token; rows that repeat
count and score alike; a text longer than a block is a block of its own; with nothing to
learn from, all counts are 0, every token is of the unknown kind and the score is 0; an
empty table gives an empty result. Only the id, the text and the `learn` condition are read.
"""

from __future__ import annotations

import json
import math
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneflow.llm.common import (
    few_at_a_time,
    numbered_blocks,
    pack,
    pack_strings,
    text_blocks,
    text_or_empty,
    total_bytes,
    unpack,
    unpack_strings,
    written,
)
from paneflow.llm.seating import scale, seat

BURN_IN, SAMPLES = 2, 2
STRENGTH = {"context": 5.0, "root": 10.0, "spelling": 2.0}
SPELLING_DISCOUNT = 0.5
BLOCK_BYTES = 18_000_000
BUCKET_BYTES = 16 << 20
SEED = 4
# Symbols of the spelling: bytes, the end of a word, the place before a word.
_END, _BEFORE, _SYMBOLS = 256, 257, 257
_WIDE = 258
# The end of a text is a word, and its start a context: no word is empty or a space.
TEXT_END, TEXT_START = b"", b" "


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


# Spelling


@dataclass(frozen=True)
class Spelling:
    """Predictive probabilities of symbols after two symbols: own mass of seen triples,
    and what each context leaves to the table of one-symbol contexts."""

    triples: np.ndarray
    mass: np.ndarray
    left: np.ndarray
    pairs: np.ndarray

    def log_prob(self, words: pa.Array) -> np.ndarray:
        """Natural logarithm of each word's probability."""
        code, start = spelled(words)
        out = self.left[code // _SYMBOLS] * self.pairs[
            code // _SYMBOLS % _WIDE, code % _SYMBOLS
        ]
        if len(self.triples):
            at = np.minimum(np.searchsorted(self.triples, code), len(self.triples) - 1)
            out += np.where(self.triples[at] == code, self.mass[at], 0.0)
        return np.add.reduceat(np.log(out), start) if len(start) else np.zeros(0)


def spelled(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the symbol triples of all words, and where each word starts."""
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    buffers = words.buffers()
    offset = np.frombuffer(buffers[1], dtype=np.int32)[words.offset:words.offset + n + 1].astype(np.int64)
    data = (
        np.frombuffer(buffers[2], dtype=np.uint8)[offset[0]:offset[-1]]
        if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    )
    offset = offset - offset[0]
    start = offset[:-1] + np.arange(n)
    symbol = np.full(len(data) + n, _END, dtype=np.int64)
    inside = np.ones(len(symbol), dtype=bool)
    inside[offset[1:] + np.arange(n)] = False
    symbol[inside] = data
    one = np.empty_like(symbol)
    one[1:], one[start] = symbol[:-1], _BEFORE
    two = np.empty_like(symbol)
    two[1:], two[start] = one[:-1], _BEFORE
    return (two * _WIDE + one) * _SYMBOLS + symbol, start


def uniform_spelling() -> Spelling:
    none = np.zeros(0)
    return Spelling(
        none.astype(np.int64), none, np.ones(_WIDE * _WIDE), np.full((_WIDE, _SYMBOLS), 1 / _SYMBOLS)
    )


# Seating of spelled symbols


def sample_spelling(codes: np.ndarray, counts: np.ndarray, old: Spelling, rng: np.random.Generator) -> Spelling:
    """Seat the symbols of all spelled words, from triples up to single symbols."""
    d, s = SPELLING_DISCOUNT, STRENGTH["spelling"]
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    context, symbol = codes // _SYMBOLS, codes % _SYMBOLS
    one = context % _WIDE

    def tables_of(count: np.ndarray, group: np.ndarray, parent: np.ndarray, width: int) -> np.ndarray:
        tables = np.minimum(count, 1)
        for _ in range(2):
            total = np.bincount(group, weights=tables, minlength=width)
            tables = seat(count, scale(s, d, total, rng)[group] * parent, d, rng, tables)
        return tables

    triple_tables = tables_of(counts, context, old.pairs[one, symbol], _WIDE * _WIDE)
    pair_count = np.zeros((_WIDE, _SYMBOLS), dtype=np.int64)
    np.add.at(pair_count, (one, symbol), triple_tables)
    row, column = np.nonzero(pair_count)
    singles = np.full(_SYMBOLS, 1 / _SYMBOLS)
    pair_tables = tables_of(pair_count[row, column], row, singles[column], _WIDE)
    single_count = np.bincount(column, weights=pair_tables, minlength=_SYMBOLS).astype(np.int64)
    seen = np.nonzero(single_count)[0]
    single_tables = np.zeros(_SYMBOLS, dtype=np.int64)
    single_tables[seen] = tables_of(
        single_count[seen], np.zeros(len(seen), dtype=np.int64), singles[seen], 1
    )
    singles = (single_count - d * single_tables + (s + d * single_tables.sum()) / _SYMBOLS) / (
        s + single_count.sum()
    )
    own = np.zeros((_WIDE, _SYMBOLS))
    own[row, column] = pair_count[row, column] - d * pair_tables
    drawn = np.bincount(row, weights=pair_tables, minlength=_WIDE)
    pairs = (own + (s + d * drawn)[:, None] * singles) / (s + pair_count.sum(1))[:, None]
    total = np.bincount(context, weights=counts, minlength=_WIDE * _WIDE)
    opened = np.bincount(context, weights=triple_tables, minlength=_WIDE * _WIDE)
    return Spelling(
        codes,
        (counts - d * triple_tables) / (s + total[context]),
        (s + d * opened) / (s + total),
        pairs,
    )


# Messages between blocks, word buckets and pair buckets


MAIL = "`to` long, kind int, sender long, body binary, extra binary, amount double"
_MAIL = pa.schema([("to", pa.int64()), ("kind", pa.int32()), ("sender", pa.int64()),
                   ("body", pa.binary()), ("extra", pa.binary()), ("amount", pa.float64())])
# To blocks.
TEXTS, NUMBERS, WORD_ANSWER, PAIR_COUNT, PAIR_ANSWER = 1, 2, 3, 4, 5
# To word buckets.
KEYS, VOCABULARY, ONCE, LIST, SUMS, STATE = 11, 12, 13, 14, 15, 16
# To pair buckets.
PAIRS, REPEATED, REPLY, TABLES, ASKED = 21, 22, 23, 24, 25
# To whoever sums the spelled symbols, by the first of them.
SPELLED = 31
# Amounts that Spark sums.
TOKENS, DISTINCT, ONE, TWO, WORD_ONE, WORD_TWO, CUSTOMERS, ROOT_TABLES, MASS, BASE = range(41, 51)


def put(*arrays: np.ndarray) -> bytes:
    """Arrays as one value: whole numbers in as few bytes as the largest needs, bytes of
    equal place together, compressed."""
    kinds, planes = [], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        if a.dtype.kind in "iu" and len(a):
            a = a.astype(np.result_type(np.min_scalar_type(a.min()), np.min_scalar_type(a.max())))
        kinds.append((a.dtype.str, len(a)))
        planes.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    head = json.dumps(kinds).encode() + b"\n"
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(planes))


def take(body: bytes) -> list[np.ndarray]:
    """The arrays of `put`, whole numbers as 64-bit ones."""
    raw = zstandard.ZstdDecompressor().decompress(body)
    at = raw.index(b"\n") + 1
    out = []
    for kind, n in json.loads(raw[:at]):
        dtype = np.dtype(kind)
        planes = np.frombuffer(raw, np.uint8, n * dtype.itemsize, at).reshape(dtype.itemsize, n)
        a = np.ascontiguousarray(planes.T).view(dtype).reshape(n)
        out.append(a.astype(np.int64) if dtype.kind in "iu" else a)
        at += n * dtype.itemsize
    return out


def gaps(increasing: np.ndarray) -> np.ndarray:
    return np.diff(increasing, prepend=0)


class Outbox:
    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def send(self, to: int, kind: int, sender: int, body: bytes, extra: bytes | None = None) -> None:
        self.rows.append((to, kind, sender, body, extra, None))

    def add(self, **amounts: float) -> None:
        for name, amount in amounts.items():
            self.rows.append((None, globals()[name], None, None, None, float(amount)))

    def table(self) -> pa.Table:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in _MAIL]
        self.rows = []
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _MAIL)], schema=_MAIL)


def inbox(rows: pa.Table) -> dict[int, list[tuple[int, bytes, bytes | None]]]:
    """Messages by kind, in the order of their senders."""
    out: dict[int, list] = {}
    columns = (rows.column(c).to_pylist() for c in ("kind", "sender", "body", "extra"))
    for kind, *message in zip(*columns):
        out.setdefault(kind, []).append(tuple(message))
    for messages in out.values():
        messages.sort(key=lambda m: m[0])
    return out


def of(mail: DataFrame, *kinds: int) -> DataFrame:
    return mail.filter(F.col("kind").isin(*kinds))


def delivered(mail: DataFrame, groups: int, answer, schema: str = MAIL) -> DataFrame:
    """Give every receiver all of its messages; about one task for each."""
    return mail.repartition(groups, "to").groupBy("to").applyInArrow(answer, schema)


def amounts(mail: DataFrame) -> dict[int, float]:
    rows = mail.filter(F.col("amount").isNotNull()).groupBy("kind").agg(F.sum("amount").alias("n")).collect()
    return {r["kind"]: r["n"] for r in rows}


# Blocks and their words


def split_blocks(texts: DataFrame, buckets: int) -> DataFrame:
    """Every block as numbers of its distinct words, and those words, by bucket and in
    order, with the number of times the block's learnt texts have them."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in numbered_blocks(batches, BLOCK_BYTES):
            number: dict[bytes, int] = {TEXT_START: 0}
            tokens, lengths = array("i"), []
            for batch in few_at_a_time(rows):
                for text in batch.column(1).to_pylist():
                    own = words_of(text)
                    own.append(TEXT_END)
                    for word in set(own).difference(number):
                        number[word] = len(number)
                    tokens.extend(map(number.__getitem__, own))
                    lengths.append(len(own))
            learn = np.concatenate([b.column(2).to_numpy(zero_copy_only=False) for b in rows])
            ids = pa.table({"id": pa.chunked_array([b.column(0) for b in rows])})
            dealt: list[list[bytes]] = [[] for _ in range(buckets)]
            for word in number:
                dealt[zlib.crc32(word) % buckets].append(word)
            place = np.empty(len(number), dtype=np.int64)
            at = 0
            for own in dealt:
                own.sort()
                place[[number[w] for w in own]] = np.arange(at, at + len(own))
                at += len(own)
            local = place[np.frombuffer(tokens, dtype=np.int32)]
            weight = np.repeat(learn, lengths)
            count = np.bincount(local[weight], minlength=len(number))
            count[place[0]] = learn.sum()
            out = Outbox()
            # Frequent words get small numbers, which take less room.
            order = np.argsort(-np.bincount(local, minlength=len(number)), kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            out.send(block, TEXTS, int(place[0]), put(rank[local], gaps(order), np.array(lengths), learn), pack(ids))
            at = 0
            for bucket, own in enumerate(dealt):
                if own:
                    out.send(bucket, KEYS, block, pack_strings(own), put(count[at:at + len(own)]))
                    at += len(own)
            yield from out.table().to_batches()

    return texts.mapInArrow(split, MAIL)


def vocabulary(rows: pa.Table) -> pa.Table:
    """The learnt words of a bucket with their counts, and for every block the places
    and counts of its words."""
    bucket = rows.column("to")[0].as_py()
    asked = [(block, unpack_strings(body), take(extra)[0]) for block, body, extra in inbox(rows)[KEYS]]
    total: dict[bytes, int] = {}
    for _, words, counts in asked:
        for word, n in zip(words, counts.tolist()):
            if n:
                total[word] = total.get(word, 0) + n
    known = sorted(total)
    count = np.array([total[w] for w in known], dtype=np.int64)
    place = dict(zip(known, range(len(known))))
    real = np.array([w != TEXT_START for w in known], dtype=bool)
    out = Outbox()
    out.send(bucket, VOCABULARY, 0, pack(pa.table({"word": pa.array(known, pa.binary())})), put(count, real))
    out.add(TOKENS=count[real].sum(), DISTINCT=real.sum(),
            WORD_ONE=(count[real] == 1).sum(), WORD_TWO=(count[real] == 2).sum())
    for block, words, _ in asked:
        # Places rise with the words, those not learnt have none.
        at = np.array([place.get(w, -1) for w in words], dtype=np.int64)
        out.send(block, NUMBERS, bucket, put(at >= 0, gaps(at[at >= 0]), count[at[at >= 0]]))
    return out.table()


# A word's number in the whole corpus: its bucket above its place there.
_SHIFT = 40


@dataclass
class Block:
    """Tokens of a block, and its distinct pairs of context and word; `dealt` are the
    pairs of learnt words, by pair bucket."""

    ids: pa.Table
    learn: np.ndarray
    lengths: np.ndarray
    count: np.ndarray
    local: np.ndarray
    context: np.ndarray
    word: np.ndarray
    pair_of: np.ndarray
    pair_count: np.ndarray
    words: np.ndarray
    dealt: list[np.ndarray]

    @staticmethod
    def read(mail: dict[int, list], buckets: int) -> Block:
        start, body, extra = mail[TEXTS][0]
        rank, order, lengths, learn = take(body)
        local = np.cumsum(order)[rank]
        learn = learn.astype(bool)
        numbers = [(bucket, *take(body)) for bucket, body, _ in mail[NUMBERS]]
        known = np.concatenate([n[1] for n in numbers])
        n = len(known)
        count, words = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        count[known] = np.concatenate([n[3] for n in numbers])
        words[known] = np.concatenate([(bucket << _SHIFT) + np.cumsum(gap) for bucket, _, gap, _ in numbers])
        before = np.empty_like(local)
        before[1:] = local[:-1]
        before[np.cumsum(lengths) - lengths] = start
        code, pair_of = np.unique(before * n + local, return_inverse=True)
        context, word = code // n, code % n
        pair_count = np.bincount(pair_of, weights=np.repeat(learn, lengths), minlength=len(code))
        known = np.nonzero((words[context] >= 0) & (words[word] >= 0))[0]
        bucket_of = pair_bucket(words[context[known]], words[word[known]], buckets)
        order = np.argsort(bucket_of, kind="stable")
        cuts = np.searchsorted(bucket_of[order], np.arange(1, buckets))
        return Block(unpack(extra), learn, lengths, count, local, context, word, pair_of,
                     pair_count.astype(np.int64), words, np.split(known[order], cuts))


def pair_bucket(context: np.ndarray, word: np.ndarray, buckets: int) -> np.ndarray:
    mixed = context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word.astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def asked_pairs(buckets: int):
    """The pairs of every block with their counts in its learnt texts."""

    def ask(rows: pa.Table) -> pa.Table:
        mail = inbox(rows)
        block, out = rows.column("to")[0].as_py(), Outbox()
        if TEXTS in mail:
            own = Block.read(mail, buckets)
            for bucket, pairs in enumerate(own.dealt):
                if len(pairs):
                    context, word = own.words[own.context[pairs]], own.words[own.word[pairs]]
                    out.send(bucket, PAIRS, block,
                             put(gaps(context), word >> _SHIFT, word & ((1 << _SHIFT) - 1), own.pair_count[pairs]))
        return out.table()

    return ask


@dataclass
class Pairs:
    """The distinct pairs of a pair bucket, in order, and where each block's pairs are."""

    words: np.ndarray
    context: np.ndarray
    word: np.ndarray
    count: np.ndarray
    at: list[tuple[int, np.ndarray]]

    @staticmethod
    def read(messages: list) -> Pairs:
        parts = []
        for block, body, _ in messages:
            gap, bucket, place, count = take(body)
            parts.append((block, np.cumsum(gap), (bucket << _SHIFT) + place, count))
        context, word, count = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        words = np.unique(np.concatenate([np.unique(context), np.unique(word)]))
        code = np.searchsorted(words, context) * len(words) + np.searchsorted(words, word)
        del context, word
        code, at = np.unique(code, return_inverse=True)
        total = np.bincount(at, weights=count, minlength=len(code)).astype(np.int64)
        cuts = np.cumsum([len(p[1]) for p in parts])[:-1]
        return Pairs(words, code // len(words), code % len(words), total,
                     list(zip((p[0] for p in parts), np.split(at, cuts))))


def by_bucket(words: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of words of one word bucket."""
    bucket = words >> _SHIFT
    starts = np.nonzero(np.diff(bucket, prepend=-1))[0].tolist()
    for a, b in zip(starts, [*starts[1:], len(words)]):
        yield int(bucket[a]), slice(a, b)


def _place(words: np.ndarray) -> np.ndarray:
    return words & ((1 << _SHIFT) - 1)


def merged_pairs(rows: pa.Table) -> pa.Table:
    """Pairs seen more than once, which have tables to draw, and for the word buckets
    what all others add to their words for good. Blocks learn their pairs' counts, and
    which of the repeated pairs they ask for stays here."""
    bucket, out = rows.column("to")[0].as_py(), Outbox()
    own = Pairs.read(inbox(rows)[PAIRS])
    n = len(own.words)
    once, more = own.count == 1, own.count > 1
    tables = np.bincount(own.context[once], minlength=n)
    customers = np.bincount(own.word[once], minlength=n)
    kept = np.nonzero(tables + customers)[0]
    for to, run in by_bucket(own.words[kept]):
        i = kept[run]
        out.send(to, ONCE, bucket, put(gaps(_place(own.words[i])), tables[i], customers[i]))
    used = np.unique(np.concatenate([own.context[more], own.word[more]]))
    words = own.words[used]
    context, word = np.searchsorted(used, own.context[more]), np.searchsorted(used, own.word[more])
    count = own.count[more]
    if len(words):
        out.send(bucket, REPEATED, 0, put(gaps(words), gaps(context), word, count))
        for to, run in by_bucket(words):
            out.send(to, LIST, bucket, put(gaps(_place(words[run]))))
        _report(out, bucket, words, context, word, np.ones(len(count), dtype=np.int64))
    rank = np.cumsum(more) - 1
    for block, at in own.at:
        out.send(block, PAIR_COUNT, bucket, put(own.count[at]))
        asked = at[more[at]]
        if len(asked):
            out.send(bucket, ASKED, block, put(gaps(rank[asked])))
    out.add(ONE=once.sum(), TWO=(own.count == 2).sum())
    return out.table()


def _report(out: Outbox, bucket: int, words, context, word, tables) -> None:
    """Tables of a pair bucket, summed for each of its words as context and as word."""
    opened = np.bincount(context, weights=tables, minlength=len(words)).astype(np.int64)
    customers = np.bincount(word, weights=tables, minlength=len(words)).astype(np.int64)
    for to, run in by_bucket(words):
        out.send(to, SUMS, bucket, put(opened[run], customers[run]))


# Sweeps


@dataclass(frozen=True)
class Known:
    tokens: int
    distinct: int
    context_discount: float
    root_discount: float


@dataclass(frozen=True)
class Totals:
    """What one sweep knows of all restaurants together."""

    root_customers: int
    root_tables: int
    # The share of all root words in units of their drawn masses, and the root's variable.
    mass: float
    root_scale: float
    spelling: Spelling
    # What the spelling that the sweep was drawn with leaves to unknown words.
    unknown: float


def _discount(one: float, two: float) -> float:
    return min(0.95, max(0.1, one / (one + 2 * two))) if one + two else 0.5


def seat_words(now: Totals, known: Known, number: int):
    """One word bucket: sums of its words, a new seating of the root, and the masses and
    variables that the pair buckets draw from."""

    def resample(rows: pa.Table) -> pa.Table:
        bucket, mail, out = rows.column("to")[0].as_py(), inbox(rows), Outbox()
        rng = np.random.default_rng([SEED, 1, number, bucket])
        _, body, extra = mail[VOCABULARY][0]
        words = unpack(body).column("word").combine_chunks()
        _, real = take(extra)
        real = real.astype(bool)
        n = len(words)
        if STATE in mail:
            fixed, fixed_customers, seats = take(mail[STATE][0][1])[:3]
        else:
            fixed, fixed_customers = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            for _, body, _ in mail.get(ONCE, []):
                gap, tables, customers = take(body)
                at = np.cumsum(gap)
                fixed[at] += tables
                fixed_customers[at] += customers
            seats = None
        lists = [(p, np.cumsum(take(body)[0])) for p, body, _ in mail.get(LIST, [])]
        opened, customers = fixed.copy(), fixed_customers.copy()
        for (_, at), (_, body, _) in zip(lists, mail.get(SUMS, [])):
            tables, arrived = take(body)
            opened[at] += tables
            customers[at] += arrived
        d, s = known.root_discount, STRENGTH["root"]
        base = np.where(real, np.exp(now.spelling.log_prob(words)), 0.0)
        seats = seat(customers, now.root_scale * base, d, rng, seats)
        mass = rng.gamma(np.maximum(customers - d * seats, 0.0))
        given = scale(STRENGTH["context"], known.context_discount, opened, rng)
        out.add(CUSTOMERS=customers.sum(), ROOT_TABLES=seats.sum(), MASS=mass.sum(), BASE=base.sum())
        mass += (s + d * now.root_tables) * base
        for p, at in lists:
            out.send(p, REPLY, bucket, put(given[at].astype(np.float32), mass[at].astype(np.float32)))
        # Only samples are asked for the rest.
        shown = [opened, customers, base.astype(np.float32)] if number >= BURN_IN else []
        out.send(bucket, STATE, number,
                 put(fixed, fixed_customers, seats, *shown))
        code, start = spelled(words)
        lengths = np.diff(np.append(start, len(code)))
        codes, at = np.unique(code, return_inverse=True)
        spelt = np.bincount(at, weights=np.repeat(seats, lengths), minlength=len(codes)).astype(np.int64)
        first = codes // (_WIDE * _SYMBOLS)
        for symbol in np.unique(first[spelt > 0]).tolist():
            i = (first == symbol) & (spelt > 0)
            out.send(symbol, SPELLED, bucket, put(gaps(codes[i]), spelt[i]))
        return out.table()

    return resample


def sum_spelled(rows: pa.Table) -> pa.Table:
    """All symbol triples with one first symbol, over all buckets."""
    parts = [take(body) for _, body, _ in inbox(rows)[SPELLED]]
    codes, at = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
    out = Outbox()
    out.send(rows.column("to")[0].as_py(), SPELLED, 0, put(codes, total))
    return out.table()


def after_words(mail: DataFrame, old: Totals, known: Known, number: int) -> Totals:
    """Totals over all buckets, and a spelling model seated anew."""
    total = amounts(mail)
    rows = delivered(of(mail, SPELLED), _groups(mail, _WIDE), sum_spelled).select("body").collect()
    parts = [take(bytes(r["body"])) for r in rows] or [[np.zeros(0, dtype=np.int64)] * 2]
    codes, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    rng = np.random.default_rng([SEED, 2, number])
    tables = int(total.get(ROOT_TABLES, 0))
    d, s = known.root_discount, STRENGTH["root"]
    return Totals(
        int(total.get(CUSTOMERS, 0)),
        tables,
        total.get(MASS, 0.0) + rng.gamma(s + d * tables),
        float(scale(s, d, tables, rng)),
        sample_spelling(codes, counts, old.spelling, rng),
        max(1.0 - total.get(BASE, 0.0), 1e-12),
    )


def _groups(mail: DataFrame, most: int) -> int:
    """Tasks for a few small groups."""
    return min(most, int(mail.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def seat_pairs(now: Totals, known: Known, number: int):
    """One pair bucket: new tables of its pairs, and their sums for the word buckets."""

    def resample(rows: pa.Table) -> pa.Table:
        bucket, mail, out = rows.column("to")[0].as_py(), inbox(rows), Outbox()
        words, context, word, count = take(mail[REPEATED][0][1])
        words, context = np.cumsum(words), np.cumsum(context)
        replies = [take(body) for _, body, _ in mail[REPLY]]
        given, mass = (np.concatenate([r[i] for r in replies]).astype(np.float64) for i in (0, 1))
        rng = np.random.default_rng([SEED, 3, number, bucket])
        tables = take(mail[TABLES][0][1])[0] if TABLES in mail else None
        tables = seat(count, given[context] * mass[word] / now.mass, known.context_discount, rng, tables)
        out.send(bucket, TABLES, number, put(tables))
        _report(out, bucket, words, context, word, tables)
        return out.table()

    return resample


def learn(vocab: DataFrame, pairs: DataFrame, known: Known, buckets: int) -> list[tuple[DataFrame, DataFrame | None, Totals]]:
    """The sampled seatings: words' state, pairs' tables, totals."""
    blank, start = uniform_spelling(), float(known.distinct)
    now = Totals(known.tokens, known.distinct, 1.0, max(start, 1.0), blank, 1.0)
    fixed = of(vocab, VOCABULARY).unionByName(of(pairs, LIST))
    state, reported, seated, samples = of(pairs, ONCE), of(pairs, SUMS), None, []
    for number in range(BURN_IN + SAMPLES):
        received = fixed.unionByName(state).unionByName(reported)
        words = written(delivered(received, buckets, seat_words(now, known, number)), "words")
        now = after_words(words, now, known, number)
        state = of(words, STATE)
        if number >= BURN_IN:
            samples.append((state, seated, now))
        if number < BURN_IN + SAMPLES - 1:
            received = of(pairs, REPEATED).unionByName(of(words, REPLY))
            received = received if seated is None else received.unionByName(seated)
            drawn = written(delivered(received, buckets, seat_pairs(now, known, number)), "tables")
            seated, reported = of(drawn, TABLES), of(drawn, SUMS)
    return samples


# Scores


def answer_words(totals: list[Totals], known: Known):
    """For every block and sample, tables and root probabilities of its words."""
    d, s = known.root_discount, STRENGTH["root"]

    def answer(rows: pa.Table) -> pa.Table:
        bucket, mail, out = rows.column("to")[0].as_py(), inbox(rows), Outbox()
        own = []
        for now, (_, body, _) in zip(totals, mail.get(STATE, [])):
            _, _, seats, opened, customers, base = take(body)
            root = (customers - d * seats + (s + d * now.root_tables) * base) / (s + now.root_customers)
            own += [opened, root.astype(np.float32)]
        for block, body, _ in mail.get(NUMBERS, []):
            at = np.cumsum(take(body)[1])
            out.send(block, WORD_ANSWER, bucket, put(*(a[at] for a in own)))
        return out.table()

    return answer


def answer_pairs(rows: pa.Table) -> pa.Table:
    """For every block, the tables of its repeated pairs in every sample."""
    bucket, mail, out = rows.column("to")[0].as_py(), inbox(rows), Outbox()
    drawn = [take(body)[0] for _, body, _ in mail.get(TABLES, [])]
    for block, body, _ in mail.get(ASKED, []):
        at = np.cumsum(take(body)[0])
        out.send(block, PAIR_ANSWER, bucket, put(*(tables[at] for tables in drawn)))
    return out.table()


def pair_probabilities(block: Block, mail: dict[int, list], totals: list[Totals], known: Known) -> np.ndarray:
    """The averaged predictive probability of each distinct pair of a block."""
    d, s = known.context_discount, STRENGTH["context"]
    root_d, root_s = known.root_discount, STRENGTH["root"]
    words = [take(body) for _, body, _ in mail.get(WORD_ANSWER, [])]
    counts = {bucket: take(body)[0] for bucket, body, _ in mail.get(PAIR_COUNT, [])}
    drawn = {bucket: take(body) for bucket, body, _ in mail.get(PAIR_ANSWER, [])}
    seen = np.nonzero(block.words >= 0)[0]
    shape = len(block.context)
    count = np.zeros(shape, dtype=np.int64)
    for bucket, at in enumerate(block.dealt):
        if len(at):
            count[at] = counts[bucket]
    room = s + np.where(block.words >= 0, block.count, 0)
    total = np.zeros(shape)
    for i, now in enumerate(totals):
        opened = np.zeros(len(block.words))
        root = np.full(len(block.words), (root_s + root_d * now.root_tables) * now.unknown
                       / (root_s + now.root_customers))
        if len(seen):
            opened[seen] = np.concatenate([w[2 * i] for w in words])
            root[seen] = np.concatenate([w[2 * i + 1] for w in words])
        tables = np.minimum(count, 1)
        for bucket, at in enumerate(block.dealt):
            if bucket in drawn:
                tables[at[count[at] > 1]] = drawn[bucket][i]
        left = (s + d * opened) / room
        total += (count - d * tables) / room[block.context] + left[block.context] * root[block.word]
    return total / len(totals)


def score_texts(
    docs: DataFrame,
    learn_from: Column,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its id, `learnt`, `n_tokens`, `n_known`, `train_tokens`,
    `base_score`, `score` and `perplexity`. Documents with `learn_from` are learnt."""
    texts = docs.select(
        F.col(id_col), text_or_empty(text).alias("_text"),
        F.coalesce(learn_from, F.lit(False)).alias("learn"),
    )
    size = total_bytes(texts, "_text")
    buckets, groups = text_blocks(size, BUCKET_BYTES), text_blocks(size, BLOCK_BYTES)
    id_type = docs.schema[id_col].dataType.simpleString()
    blocks = written(split_blocks(texts, buckets), "blocks")
    vocab = written(delivered(of(blocks, KEYS), buckets, vocabulary), "vocabulary")
    numbered = of(blocks, TEXTS).unionByName(of(vocab, NUMBERS))
    asked = written(delivered(numbered, groups, asked_pairs(buckets)), "asked")
    pairs = written(delivered(asked, buckets, merged_pairs), "pairs")
    total = amounts(vocab) | amounts(pairs)
    known = Known(
        int(total.get(TOKENS, 0)), int(total.get(DISTINCT, 0)),
        _discount(total.get(ONE, 0), total.get(TWO, 0)),
        _discount(total.get(WORD_ONE, 0), total.get(WORD_TWO, 0)),
    )
    samples = learn(vocab, pairs, known, buckets)
    totals = [now for _, _, now in samples]
    # Messages go from the words' buckets back to the blocks that had asked.
    back = of(vocab, NUMBERS).withColumns({"to": F.col("sender"), "sender": F.col("to")})
    of_words, of_pairs = back, of(pairs, ASKED)
    for state, seated, _ in samples:
        of_words = of_words.unionByName(state)
        of_pairs = of_pairs.unionByName(seated)
    answers = delivered(of_words, buckets, answer_words(totals, known)).unionByName(
        delivered(of_pairs, buckets, answer_pairs)
    ).unionByName(of(pairs, PAIR_COUNT))
    tokens, room = known.tokens, known.tokens + known.distinct + 1
    names = [id_col, "learnt", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(rows: pa.Table) -> pa.Table:
        mail = inbox(rows)
        own = Block.read(mail, buckets)
        log10 = np.log10(np.maximum(pair_probabilities(own, mail, totals, known), 1e-300))[own.pair_of]
        count = own.count[own.local]
        starts = np.cumsum(own.lengths) - own.lengths
        # Every text has its end token, so no run is empty.
        per_text = (np.add.reduceat(a, starts) for a in (
            (count > 0).astype(np.int64), np.log10((count + 1) / room), log10))
        n_known, base, scores = per_text
        columns = [own.ids.column("id"), own.learn, own.lengths, n_known,
                   np.full(len(starts), tokens), base, scores]
        return pa.table(columns, names)

    return (
        delivered(
            numbered.unionByName(answers), groups, score,
            f"`{id_col}` {id_type}, learnt boolean, n_tokens long, n_known long, "
            "train_tokens long, base_score double, score double",
        )
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    )
