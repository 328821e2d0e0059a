"""Exact rolling sums per event on a stream (L8, L9), with late corrections.

State per key, in event time:

* ``sums``: slice -> (amount, events), the whole slice added up
* ``events``: slice -> the slice's events in time order

A frame that ends at an event is the tail of its oldest slice, the sums of the
slices between, and the head of its own slice, so only edge slices are read
event by event. A slice has an event-time timer: once the watermark has passed
its end by the longest frame, no event that may still arrive can reach it, and
it is removed, so a key holds one frame (plus the watermark's delay) of events
however long the stream runs.

An event that arrives late (within the watermark) changes the frames of events
already emitted. Those are emitted again with a higher ``revision``; the last
revision of an event equals the batch window over all events accepted so far
(``latest_revisions`` keeps it). Amounts are whole cents.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from carelake.operators.windows import latest_by
from carelake.session import use_rocksdb

MICROS = 10 ** 6

# Spark also loads the processor in a Python process beside the driver, which does
# not see the driver program's sys.path: send the class, not its name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class RollingFrames(StatefulProcessor):
    """Input: key, event_id, event_timestamp, amount. ``frames`` are seconds;
    ``slice_seconds`` should be a small part of the longest."""

    def __init__(self, frames: list[int], slice_seconds: int):
        self.frames = [f * MICROS for f in frames]
        self.width = slice_seconds * MICROS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", "slice long", "amount long, events long")
        self.events = handle.getMapState("events", "slice long", "t array<long>, amount array<long>, id array<long>")
        self.revision = handle.getValueState("revision", "n long")

    def _load(self, piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.events.containsKey((piece,)):
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.array(x, np.int64) for x in self.events.getValue((piece,)))

    def _insert(self, piece: int, t: np.ndarray, amount: np.ndarray, ids: np.ndarray) -> None:
        old = self._load(piece)
        if not len(old[0]):
            end = (piece + 1) * self.width + max(self.frames)
            self.handle.registerTimer(end // 1000 + 1)
        t, amount, ids = (np.concatenate(p) for p in zip(old, (t, amount, ids), strict=True))
        order = np.lexsort((ids, t))
        self.events.updateValue((piece,), tuple(x[order].tolist() for x in (t, amount, ids)))
        self.sums.updateValue((piece,), (int(amount.sum()), len(t)))

    def _frames_of(self, piece: int, t: np.ndarray, own: tuple, sums: dict[int, tuple[int, int]]) -> list[np.ndarray]:
        """Per frame the amounts, then per frame the numbers of events, for events
        of one slice at times ``t``."""
        amounts, counts = [], []
        head = np.searchsorted(own[0], t, side="right")  # events at the same time are in the frame
        own_total = np.concatenate(([0], np.cumsum(own[1])))
        for frame in self.frames:
            first = t - frame
            oldest = first // self.width
            amount, count = np.zeros(len(t), np.int64), np.zeros(len(t), np.int64)
            for edge in np.unique(oldest).tolist():
                here = oldest == edge
                if edge == piece:
                    tail = np.searchsorted(own[0], first[here], side="left")
                    amount[here], count[here] = own_total[head[here]] - own_total[tail], head[here] - tail
                    continue
                times, values, _ = self._load(edge)
                total = np.concatenate(([0], np.cumsum(values)))
                tail = np.searchsorted(times, first[here], side="left")
                between = [sums[s] for s in sums if edge < s < piece]
                amount[here] = own_total[head[here]] + total[-1] - total[tail] + sum(b[0] for b in between)
                count[here] = head[here] + len(times) - tail + sum(b[1] for b in between)
            amounts.append(amount)
            counts.append(count)
        return [*amounts, *counts]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        least, most = None, None
        for batch in rows:  # an Arrow batch at a time
            t = batch["event_timestamp"].to_numpy("datetime64[us]").astype(np.int64)
            amount, ids = batch["amount"].to_numpy(np.int64), batch["event_id"].to_numpy(np.int64)
            piece = t // self.width
            for p in np.unique(piece).tolist():
                here = piece == p
                self._insert(p, t[here], amount[here], ids[here])
            least = int(t.min()) if least is None else min(least, int(t.min()))
            most = int(t.max()) if most is None else max(most, int(t.max()))
        if least is None:
            return
        revision = (self.revision.get()[0] if self.revision.exists() else 0) + 1
        self.revision.update((revision,))
        sums = {k[0]: (v[0], v[1]) for k, v in self.sums.iterator()}
        # whatever ends before the first new event, or starts after the last, is unchanged
        until = most + max(self.frames)
        for p in sorted(s for s in sums if least // self.width <= s <= until // self.width):
            own = self._load(p)
            use = (own[0] >= least) & (own[0] <= until)
            if not use.any():
                continue
            found = self._frames_of(p, own[0][use], own, sums)
            n = len(self.frames)
            out = {"event_id": own[2][use], "key": [key[0]] * int(use.sum()),
                   "event_timestamp": pd.to_datetime(own[0][use], unit="us"), "revision": revision}
            out |= {f"amount_{i}": found[i] for i in range(n)} | {f"events_{i}": found[n + i] for i in range(n)}
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        done = expiredTimerInfo.getExpiryTimeInMs() * 1000
        for piece in [k[0] for k in self.sums.keys()]:
            if (piece + 1) * self.width + max(self.frames) <= done:
                self.sums.removeKey((piece,))
                self.events.removeKey((piece,))
        return iter(())

    def close(self) -> None:
        pass


def rolling_frames(stream: DataFrame, key: str, amount: Column, frames: list[int], slice_seconds: int) -> DataFrame:
    """event_id, key, event_timestamp, revision, and per frame i (seconds, as
    listed) ``amount_i`` and ``events_i`` over the events of the key in the frame up
    to and including the event's time. ``stream`` needs a watermark on
    ``event_timestamp`` and one row per event_id; null keys, times and ids take no
    part, a null amount counts as 0."""
    use_rocksdb(stream.sparkSession)
    rows = stream.select(F.col(key).cast("string").alias("key"), F.col("event_id").cast("long").alias("event_id"),
                         "event_timestamp", F.coalesce(amount.cast("long"), F.lit(0)).alias("amount"))
    rows = rows.where("key IS NOT NULL AND event_id IS NOT NULL AND event_timestamp IS NOT NULL")
    out = ["event_id long", "key string", "event_timestamp timestamp", "revision long"]
    out += [f"{c}_{i} long" for c in ("amount", "events") for i in range(len(frames))]
    return rows.groupBy("key").transformWithStateInPandas(
        RollingFrames(frames, slice_seconds), ", ".join(out), "Append", "EventTime")


def latest_revisions(emitted: DataFrame) -> DataFrame:
    """Of each event the row last emitted."""
    rest = [c for c in emitted.columns if c not in ("event_id", "revision")]
    return latest_by(emitted, "event_id", ["revision"], ["revision", *rest])
