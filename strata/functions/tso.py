"""Timestamp arithmetic: a timestamp is ``physical milliseconds << 18 | logical``."""

from __future__ import annotations

import threading
import time

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of the logical part, its mask, the sentinel for "newest", default and largest lock times in ms.
LOGICAL_BITS = 18
LOGICAL_MASK = (1 << LOGICAL_BITS) - 1
LATEST = (1 << 63) - 1
DEFAULT_LOCK_TTL_MS, LOCK_TTL_FACTOR_MS, MOST_LOCK_TTL_MS = 3000, 6000, 20_000
#: Bytes of a transaction from which its locks live longer.
TTL_FROM_BYTES = 16 * 1024


class TimestampError(ValueError):
    """A timestamp that may not be read or set."""


def compose(physical_ms: Column, logical: Column) -> Column:
    return F.shiftleft(physical_ms.cast("long"), LOGICAL_BITS) + logical


def physical(ts: Column) -> Column:
    return F.shiftrightunsigned(ts, LOGICAL_BITS)


def logical(ts: Column) -> Column:
    return ts.bitwiseAND(F.lit(LOGICAL_MASK))


def from_time(t: Column) -> Column:
    """Time to timestamp, truncated to milliseconds, logical part 0."""
    return F.shiftleft(F.unix_millis(t.cast("timestamp")), LOGICAL_BITS)


def to_time(ts: Column) -> Column:
    return F.timestamp_millis(physical(ts))


def lower_limit(t: Column, longest_txn_ms: int) -> Column:
    """Smallest start timestamp a transaction still running at ``t`` can have."""
    return F.shiftleft(F.unix_millis(t.cast("timestamp")) - longest_txn_ms, LOGICAL_BITS)


def is_expired(lock_ts: Column, ttl_ms: Column, now_ts: Column) -> Column:
    """The client's rule (>=); see ``is_expired_strictly`` for the storage's."""
    return physical(now_ts) >= physical(lock_ts) + ttl_ms


def is_expired_strictly(lock_ts: Column, ttl_ms: Column, now_ts: Column) -> Column:
    return physical(lock_ts) + ttl_ms < physical(now_ts)


def until_expired(lock_ts: Column, ttl_ms: Column, now_ts: Column) -> Column:
    return physical(lock_ts) + ttl_ms - physical(now_ts)


def lock_ttl(txn_bytes: Column, elapsed_ms: Column) -> Column:
    """3 s, or 6 s * sqrt(MiB) up to 20 s for larger transactions, plus the time already passed."""
    large = F.floor(F.lit(float(LOCK_TTL_FACTOR_MS)) * F.sqrt(txn_bytes / F.lit(1048576.0))).cast("long")
    ttl = F.when(txn_bytes >= TTL_FROM_BYTES, F.least(F.greatest(large, F.lit(DEFAULT_LOCK_TTL_MS)), F.lit(MOST_LOCK_TTL_MS))).otherwise(F.lit(DEFAULT_LOCK_TTL_MS))
    return ttl.cast("long") + elapsed_ms


def parse_gc_time(text: Column) -> Column:
    """A GC time in the form with an offset, or the older one with a zone name after it."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyyMMdd-HH:mm:ss.SSS Z")),
        F.try_to_timestamp(text, F.lit("yyyyMMdd-HH:mm:ss Z")),
        F.try_to_timestamp(F.regexp_replace(text, r" [A-Za-z]+$", ""), F.lit("yyyyMMdd-HH:mm:ss Z")),
    )


def check_read_ts(ts: int, *, newest: int, stale: bool = False) -> int:
    """A timestamp that may be read; LATEST or None reads the newest state, which a stale read cannot ask for."""
    if ts is None or ts == LATEST or ts == (1 << 64) - 1:
        if stale:
            raise TimestampError("a stale read needs a past timestamp")
        return LATEST
    if ts >= LATEST or ts < 0:
        raise TimestampError(f"{ts} lies in the reserved range")
    if ts > newest:
        raise TimestampError(f"{ts} lies in the future of {newest}")
    return ts


class LocalOracle:
    """Strictly increasing timestamps of one driver, the low-resolution one, stale ones and the external one."""

    def __init__(self, clock=lambda: time.time_ns() // 1_000_000, offset_ms: int = 0):
        self.clock, self.offset_ms = clock, offset_ms
        self.last, self.external, self.lock = 0, 0, threading.Lock()

    def timestamp(self) -> int:
        with self.lock:
            self.last = max(self.last + 1, self.clock() + self.offset_ms << LOGICAL_BITS)
            return self.last

    def low_resolution(self) -> int:
        return self.last or self.timestamp()

    def stale(self, seconds: int) -> int:
        now = self.timestamp() >> LOGICAL_BITS
        if seconds * 1000 >= now:
            raise TimestampError(f"{seconds} s reach before time 0")
        return now - seconds * 1000 << LOGICAL_BITS

    def set_external(self, ts: int) -> None:
        if ts > self.timestamp():
            raise TimestampError("the external timestamp cannot lie in the future")
        if ts < self.external:
            raise TimestampError("the external timestamp cannot go back")
        self.external = ts

    def until_commit(self, commit_ts: int, wait_until: int) -> bool:
        """Whether a commit timestamp lies after the one that must have passed."""
        return commit_ts > wait_until
