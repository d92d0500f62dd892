"""Streams of market data: windowed totals, candles, and books kept by snapshots and changes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_totals(events: DataFrame, *, at: str, by: str, value: str, length: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Count and sum per window and group; rows later than ``late`` are dropped by the watermark, as streams define it.

    The same on a table and on a stream.
    """
    window = F.window(at, length, slide or length)
    source = events.withWatermark(at, late) if events.isStreaming else events
    out = source.groupBy(window.alias("w"), F.col(by)).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n", "total")


def candles(events: DataFrame, *, at: str, by: str, value: str, length: str, late: str = "10 minutes") -> DataFrame:
    """Open, high, low, close per window: the latest candle is replaced until its window closes, then it stays."""
    source = events.withWatermark(at, late) if events.isStreaming else events
    out = source.groupBy(F.window(at, length).alias("w"), F.col(by)).agg(
        F.min_by(value, at).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, at).alias("close")
    )
    return out.select(F.col("w.start").alias("start"), by, "open", "high", "low", "close")


def replace_then_append(messages: DataFrame, *, key: str = "key", slot: str = "slot", order: str = "seq") -> DataFrame:
    """Messages of a keyed list in which a message of the latest slot replaces it and one of a new slot is appended.

    What remains is, for each slot, its last message: an aggregate, in place of state.
    """
    rest = [c for c in messages.columns if c not in (key, slot)]
    last = messages.groupBy(key, slot).agg(F.max_by(F.struct(*rest), order).alias("r"))
    return last.select(key, slot, *[F.col(f"r.{c}").alias(c) for c in rest])


BOOK = "key string, seq long, levels long, best double"
_STATE = "seq long, prices array<double>, sizes array<double>"


def order_books(messages: DataFrame) -> DataFrame:
    """Books kept from (key, seq, kind, price, size) messages: snapshots empty a book first, deltas put a level, size 0 removes it.

    Messages not after the last seen sequence number are left out. Out come, per key
    and trigger, the sequence number, levels and best price. State is one book per key.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seq, prices, sizes = state.get if state.exists else (-1, [], [])
        book = dict(zip(prices, sizes))
        rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
        for r in rows.itertuples(index=False):
            if r.seq < seq or (r.seq == seq and r.kind == "snapshot"):
                continue
            if r.kind == "snapshot" and r.seq > seq:
                book = {}
            seq = int(r.seq)
            if r.size == 0:
                book.pop(float(r.price), None)
            else:
                book[float(r.price)] = float(r.size)
        state.update((seq, list(book), list(book.values())))
        yield pd.DataFrame([(key[0], seq, len(book), min(book) if book else None)], columns=["key", "seq", "levels", "best"])

    return messages.groupBy("key").applyInPandasWithState(update, BOOK, _STATE, "update", GroupStateTimeout.NoTimeout)
