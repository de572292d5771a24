"""Wait and notify over a stream, decided in event time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signals, or waiting rows, in one value of the state.
_CHUNK = 4096
# Rows that leave a task in one frame.
_FRAME = 10_000

_META = (
    "signals array<struct<id: bigint, first: bigint, last: bigint, n: bigint>>, "
    "held array<struct<id: bigint, low: bigint, n: bigint>>, next_id bigint, timer bigint"
)


def _combiner():
    """Sums the signals of each key and time within a batch, before they are shuffled."""

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            is_signal = batch["row"].isna()
            yield batch[~is_signal]
            summed = batch[is_signal].groupby(["key", "at"], as_index=False)["amount"].sum()
            yield summed.assign(row=None)[["key", "row", "amount", "at"]]

    return combine


def _processor(target: int, ttl: int, chunk: int):
    """The state processor, made here so that executors need no module of ours.

    Times are in milliseconds. A row at t is due at t + ttl + 1, when no signal of its window
    can come any more. The state of a group of keys is a directory of chunks, of signals and
    of waiting rows. One timer for the group fires when its first row is due; then all rows
    that are due are decided together: of each chunk of signals in reach the running sums
    are made, and a window is the difference of two of them, found by binary search. So
    a decision holds the due rows and one chunk, whatever the number of signals.
    """
    import numpy as np
    from pyspark.sql.streaming import StatefulProcessor

    class WaitNotify(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.meta = handle.getValueState("meta", _META)
            self.signals = handle.getMapState("signals", "id bigint", "key array<string>, at array<bigint>, amount array<bigint>")
            self.held = handle.getMapState("held", "id bigint", "key array<string>, due array<bigint>, rows array<string>")

        def handleInputRows(self, key, rows, timerValues):
            new = pd.concat(list(rows))
            found = self.meta.get() if self.meta.exists() else ([], [], 0, None)
            signals, held, self.next_id, timer = [tuple(c) for c in found[0]], [tuple(c) for c in found[1]], found[2], found[3]
            is_signal = new["row"].isna()
            heard = new[is_signal].sort_values("at")
            if len(heard):
                signals = self._add(self.signals, signals, heard["at"], heard[["key", "at", "amount"]])
            waiting = new[~is_signal].assign(due=lambda df: df["at"] + ttl + 1).sort_values("due")
            if len(waiting):
                held = self._add(self.held, held, waiting["due"], waiting[["key", "due", "row"]])
            self._keep(signals, held, timer)
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = timerValues.getCurrentWatermarkInMs()
            signals, held, self.next_id, _ = self.meta.get()
            signals, ready = [tuple(c) for c in signals], [c for c in held if c[1] < now]
            held = [tuple(c) for c in held if c[1] >= now]
            if ready:
                parts = []
                for c in ready:
                    parts.append(pd.DataFrame(dict(zip(("key", "due", "row"), map(list, self.held.getValue((c[0],))), strict=True))))
                    self.held.removeKey((c[0],))
                rows = pd.concat(parts).sort_values("due")
                later = rows[rows["due"] >= now]
                rows = rows[rows["due"] < now]
                enough = self._sums(rows, signals) >= target
                for k in range(0, len(rows), _FRAME):
                    yield pd.DataFrame({
                        "row": rows["row"].iloc[k : k + _FRAME],
                        "outcome": np.where(enough[k : k + _FRAME], "released", "expired"),
                    })
                if len(later):
                    held = self._add(self.held, held, later["due"], later)
            # No row that is still to be decided counts what is older.
            for c in signals:
                if c[2] < now - 2 * ttl - 1:
                    self.signals.removeKey((c[0],))
            self._keep([c for c in signals if c[2] >= now - 2 * ttl - 1], held, None)

        def _add(self, state, directory, times, new):
            """Put rows in order of ``times`` into the last chunk while it is short, else into new ones."""
            if directory and directory[-1][-1] + len(new) <= chunk:
                last = directory.pop()
                old = state.getValue((last[0],))
                new = pd.concat([pd.DataFrame(dict(zip(new.columns, map(list, old), strict=True))), new])
                state.removeKey((last[0],))
                times = new.iloc[:, 1]
            for k in range(0, len(new), chunk):
                part, own = new.iloc[k : k + chunk], times.iloc[k : k + chunk]
                state.updateValue((self.next_id,), tuple(part[c].tolist() for c in part))
                ends = (int(own.min()), int(own.max())) if state is self.signals else (int(own.min()),)
                directory.append((self.next_id, *ends, len(part)))
                self.next_id += 1
            return directory

        def _keep(self, signals, held, timer):
            """Write the directory, with a timer for the first row, else for the time to forget the signals."""
            wanted = min((c[1] for c in held), default=None)
            if wanted is None and signals:
                # An earlier timer does as well: it looks again.
                wanted = timer if timer is not None else max(c[2] for c in signals) + 2 * ttl + 2
            if wanted is None:
                self.meta.clear()
                return
            if timer is not None and wanted < timer:
                self.handle.deleteTimer(timer)
            if timer is None or wanted < timer:
                self.handle.registerTimer(wanted)
                timer = wanted
            self.meta.update((signals, held, self.next_id, timer))

        def _sums(self, rows, signals):
            """The sum of the signals of the key of each row within its window."""
            names = pd.Index(rows["key"].unique())
            code, time = names.get_indexer(rows["key"]).astype(np.int64), rows["due"].to_numpy() - ttl - 1
            total = np.zeros(len(rows), np.int64)
            for part, first, last, _ in signals:
                if last < time.min() - ttl or first > time.max() + ttl:
                    continue
                keys, at, amount = self.signals.getValue((part,))
                own, at, amount = names.get_indexer(list(keys)).astype(np.int64), np.array(at, np.int64), np.array(amount, np.int64)
                # One number for key and time; keys without a due row are left out.
                span = last - first + 2
                place = (own * span + at - first)[own >= 0]
                order = np.argsort(place, kind="stable")
                place, running = place[order], np.concatenate([[0], np.cumsum(amount[own >= 0][order])])
                low = np.clip(time - ttl - first, 0, span - 1)
                high = np.clip(time + ttl - first, -1, span - 1)
                total += running[np.searchsorted(place, code * span + high, "right")] - running[np.searchsorted(place, code * span + low)]
            return total

        def close(self):
            pass

    return WaitNotify()


def wait_notify_stream(
    df: DataFrame,
    key: str,
    target: int,
    ttl_seconds: int,
    amount: Column,
    ts: str = "ts",
    watermark: str = "1 hour",
    salts: int = 4,
    groups: int = 128,
    chunk: int = _CHUNK,
) -> DataFrame:
    """Rows that wait until the signals for their key add up to ``target``.

    A row where ``amount`` is null waits; any other row is a signal of that
    amount. A row is ``released`` if the signals of its key within ``ttl_seconds``
    before and after it add up to ``target``, else ``expired``. It is decided once the
    watermark is past that time, so the batches that rows and signals come in make no
    difference; what the watermark declares late is dropped, as everywhere.

    Keys are dealt to ``groups`` groups, as many as the cluster has cores or more, which keep
    their state together. The waiting rows of one key are spread over up to ``salts`` of
    them, and signals are summed for each batch and time before each of these gets a copy
    of the sum, so a key with very many rows is held by several tasks. A value of the state
    holds at most ``chunk`` signals or rows.
    """
    flat = df.select(
        F.col(key).cast("string").alias("key"),
        F.when(amount.isNull(), F.to_json(F.struct(*df.columns))).alias("row"),
        F.coalesce(amount.cast("bigint"), F.lit(0)).alias("amount"),
        F.col(ts).cast("timestamp").alias("ts"),
    )
    combined = flat.withWatermark("ts", watermark).select(
        "key", "row", "amount", F.unix_millis("ts").alias("at")
    ).mapInPandas(_combiner(), "key string, row string, amount bigint, at bigint")
    own = F.when(
        F.col("row").isNull(), F.array_distinct(F.array(*[F.pmod(F.xxhash64("key", F.lit(s)), F.lit(groups)) for s in range(salts)]))
    ).otherwise(F.array(F.pmod(F.xxhash64("key", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")), F.lit(groups))))
    dealt = combined.where(F.col("key").isNotNull() | F.col("row").isNotNull()).withColumn("group", F.explode(own))
    out = dealt.groupBy("group").transformWithStateInPandas(
        statefulProcessor=_processor(target, ttl_seconds * 1000, chunk),
        outputStructType="row string, outcome string",
        outputMode="append",
        timeMode="EventTime",
    )
    return out.select(F.from_json("row", df.schema).alias("row"), "outcome").select(
        "row.*", "outcome"
    )
