"""Window state of the streaming jobs.

Spark's own watermark handling drops late rows before an operator sees them. The
jobs therefore give Spark a watermark with a very long delay, `HORIZON_MS`, and
shift it back: with the wanted delay D, Spark's watermark plus (horizon - D) is
the watermark of the job, and a timer for job time t is set at t less that shift.

State is kept per bucket of keys and window, not per key: all windows of a bucket
that end together share their timers, and one call serves all their rows. What is
kept are the records and the digests of all of them, so a record delivered again
changes nothing. Operators send single rows, told apart by `kind`; lists are put
together from them by Spark (`streaming.results`). A call never holds more than the
rows of its batch and `CHUNK` rows of state.

Every access to state is a round trip to the JVM, so state is kept many rows at a time:
records in numbered packs, digests in shards by their first hex digits. A window starts
with one shard and splits all of them by one more digit when they hold `SHARD_ROWS` on
average, so a row costs the rewriting of a few KB at most, however long the window.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

HORIZON_MS = 3650 * 86_400_000
# Set on a state that met no watermark yet; due as soon as there is one.
WAKE_MS = 1
# Window of rows that have none because they could not be read.
NO_WINDOW = -(1 << 62)
CHUNK = 10_000
SHARD_ROWS = 256
# A pack ends with the row that brings it to this many rows or characters.
PACK_ROWS, PACK_CHARS = 1_000, 1 << 18
DIGEST_BYTES = 32
COLUMNS = ("w_start", "kind", "fired_at", "fresh", "body")


@dataclass(frozen=True)
class WindowSettings:
    size_ms: int
    lateness_ms: int
    shift_ms: int  # 0 in the processing-time domain
    arrival: tuple[str, ...]
    early_ms: int = 0
    event_domain: bool = True


class WindowProcessor(StatefulProcessor):
    """What both kinds of window have in common."""

    INFO = "fired boolean, next_early bigint"
    SIZE = "n_rows bigint, packs bigint, depth int"

    def __init__(self, settings: WindowSettings):
        self.s = settings

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("digests", "shard string", "digests binary")
        # Bodies are JSON texts, in which line ends are escaped, and so go line by line.
        self.packs = handle.getMapState("packs", "number bigint", "bodies string")
        self.size = handle.getValueState("size", self.SIZE)
        self.info = handle.getValueState("info", self.INFO)

    def close(self) -> None:
        pass

    def _clear(self) -> None:
        self.seen.clear()
        self.packs.clear()
        self.size.clear()
        self.info.clear()

    def _now(self, timers) -> int | None:
        """Job time: wall clock, or the shifted watermark once there is one."""
        if not self.s.event_domain:
            return timers.getCurrentProcessingTimeInMs()
        seen = timers.getCurrentWatermarkInMs()
        return seen + self.s.shift_ms if seen > 0 else None

    def _timer(self, at_ms: int) -> None:
        self.handle.registerTimer(at_ms - self.s.shift_ms)

    def _incoming(self, frames: Iterable[pd.DataFrame]) -> pd.DataFrame:
        """Rows of the batch in order of arrival."""
        return pd.concat(list(frames)).sort_values(list(self.s.arrival), kind="stable")

    def _store(self, incoming: pd.DataFrame) -> list[bool]:
        """Keep records not seen before; says which rows those were."""
        digests, bodies = incoming["digest"].tolist(), incoming["body"].tolist()
        n_rows, packs, depth = self._size()
        while n_rows + len(digests) > SHARD_ROWS << (4 * depth):
            if n_rows:
                self._split(depth)
            depth += 1
        by_shard = defaultdict(list)
        for place, digest in enumerate(digests):
            by_shard[digest[:depth]].append(place)
        fresh = [False] * len(digests)
        for shard, places in by_shard.items():
            held = self._shard(shard) if n_rows else []
            known, before = set(held), len(held)
            for place in places:
                digest = bytes.fromhex(digests[place])
                if digest not in known:
                    known.add(digest)
                    held.append(digest)
                    fresh[place] = True
            if len(held) > before:
                self._put_shard(shard, held)
        added = [body for body, new in zip(bodies, fresh) if new]
        for pack in self._packed(added):
            self.packs.updateValue((packs,), ("\n".join(pack),))
            packs += 1
        if added:
            self.size.update((n_rows + len(added), packs, depth))
        return fresh

    def _size(self) -> tuple[int, int, int]:
        """Rows kept, packs, and hex digits that tell shards apart."""
        return tuple(self.size.get()) if self.size.exists() else (0, 0, 0)

    def _shard(self, shard: str) -> list[bytes]:
        key = ("#" + shard,)
        if not self.seen.containsKey(key):
            return []
        held = bytes(self.seen.getValue(key)[0])
        return [held[i:i + DIGEST_BYTES] for i in range(0, len(held), DIGEST_BYTES)]

    def _put_shard(self, shard: str, digests: list[bytes]) -> None:
        self.seen.updateValue(("#" + shard,), (b"".join(digests),))

    def _split(self, depth: int) -> None:
        """Tell shards apart by one more digit."""
        for digits in product("0123456789abcdef", repeat=depth):
            shard, parts = "".join(digits), defaultdict(list)
            for digest in self._shard(shard):
                parts[digest.hex()[:depth + 1]].append(digest)
            for part, digests in parts.items():
                self._put_shard(part, digests)
            if parts:
                self.seen.removeKey(("#" + shard,))

    @staticmethod
    def _packed(bodies: list[str]) -> Iterator[list[str]]:
        pack, chars = [], 0
        for body in bodies:
            pack.append(body)
            chars += len(body)
            if len(pack) >= PACK_ROWS or chars >= PACK_CHARS:
                yield pack
                pack, chars = [], 0
        if pack:
            yield pack

    def _frame(self, start: int, kind: str, bodies: list[str], fresh=True, at: int = 0) -> pd.DataFrame:
        n = len(bodies)
        marks = fresh if isinstance(fresh, list) else [fresh] * n
        values = ([start] * n, [kind] * n, [at] * n, marks, bodies)
        return pd.DataFrame(dict(zip(COLUMNS, values)))

    def _contents(self, start: int, kind: str, at: int = 0) -> Iterator[pd.DataFrame]:
        """All records of the window, some at a time."""
        chunk = []
        for number in range(self._size()[1]):
            pack = self.packs.getValue((number,))[0].split("\n")
            if len(chunk) + len(pack) > CHUNK:
                yield self._frame(start, kind, chunk, at=at)
                chunk = []
            chunk += pack
        if chunk:
            yield self._frame(start, kind, chunk, at=at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start = key[1]
        incoming = self._incoming(rows)
        if start == NO_WINDOW:
            yield self._frame(start, "dead_letter", incoming["body"].tolist())
            return
        yield from self.take(start, incoming, self._now(timerValues))

    def take(self, start: int, incoming: pd.DataFrame, now: int | None) -> Iterator[pd.DataFrame]:
        raise NotImplementedError


class LatenessProcessor(WindowProcessor):
    """`on_time` rows when the watermark reaches the end of the window, a `refire` row
    for each allowed-late one, rows beyond that given back as `late`."""

    def take(self, start: int, incoming: pd.DataFrame, now: int | None) -> Iterator[pd.DataFrame]:
        last = start + self.s.size_ms - 1
        if now is not None and now >= last + self.s.lateness_ms:
            yield self._frame(start, "late", incoming["body"].tolist())
            return
        if not self.info.exists():
            self.info.update((False, None))
            self._timer(last + self.s.lateness_ms)
            if now is None or now < last:
                self._timer(last)
        if now is None or now < last:
            self._store(incoming)
            return
        # The batch's rows come before its timers, so the on-time rows may be due.
        if not self.info.get()[0]:
            yield from self._contents(start, "on_time")
            self.info.update((True, None))
        fresh = self._store(incoming)
        yield self._frame(start, "refire", incoming["body"].tolist(), fresh)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = key[1]
        last = start + self.s.size_ms - 1
        due = expiredTimerInfo.getExpiryTimeInMs() + self.s.shift_ms
        if due == last and self.info.exists() and not self.info.get()[0]:
            yield from self._contents(start, "on_time")
            self.info.update((True, None))
        if due >= last + self.s.lateness_ms:
            self._clear()


class EarlyFireProcessor(WindowProcessor):
    """All rows so far at aligned instants before the window's end as `early`, all rows
    some time after it as `final`, later rows given back as `late`.

    Keys of a bucket share their instants: the next one is always the first after the
    clock, whichever key came first.
    """

    def _schedule(self, start: int, now: int) -> int | None:
        """Set the timer of the next early pane, if one is left."""
        at = now - now % self.s.early_ms + self.s.early_ms
        if at >= start + self.s.size_ms:
            return None
        self._timer(at)
        return at

    def _next(self) -> int | None:
        return self.info.get()[1] if self.info.exists() else None

    def take(self, start: int, incoming: pd.DataFrame, now: int | None) -> Iterator[pd.DataFrame]:
        closes = start + self.s.size_ms + self.s.lateness_ms
        if now is not None and now >= closes:
            yield self._frame(start, "late", incoming["body"].tolist())
            return
        if not self.info.exists():
            self._timer(closes)
            if now is None:
                self.handle.registerTimer(WAKE_MS)
            self.info.update((False, None if now is None else self._schedule(start, now)))
        else:
            # A pane that fell due shows what was there before this batch.
            at = self._next()
            if at is not None and now is not None and now >= at:
                yield from self._contents(start, "early", at)
                self.info.update((False, self._schedule(start, now)))
        self._store(incoming)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, raw = key[1], expiredTimerInfo.getExpiryTimeInMs()
        now = self._now(timerValues)
        if raw == WAKE_MS and self.s.event_domain:
            if self.info.exists() and self._next() is None:
                self.info.update((False, self._schedule(start, now)))
            return
        due = raw + self.s.shift_ms
        if due == start + self.s.size_ms + self.s.lateness_ms:
            yield from self._contents(start, "final", due)
            self._clear()
        elif due == self._next():
            yield from self._contents(start, "early", due)
            self.info.update((False, self._schedule(start, now)))
