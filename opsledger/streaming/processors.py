"""Keyed streaming state: one small entry per series, with event-time timers.

The processors are classes made by functions, so that they travel to the executors as they are
and need no installed package there.
"""

from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StatefulProcessor

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which timers and lists need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def alert_processor(series: list[str], step_s: int, hold_s: int, late_s: int) -> StatefulProcessor:
    """States of evaluations, for ``transformWithStateInPandas`` over the columns ``series``.

    Rows are ``at_us`` (time in microseconds), ``value`` and ``breach``. A series keeps its evaluations
    of the last ``late_s`` seconds, and of all before only the last one's time and the start of its
    run. New evaluations are put among the kept ones, and the states from the first new one on
    are given out again. Rows behind the watermark come out as ``late``, without a state. When the
    watermark has left a series' last evaluation more than a step behind, nothing that may still
    come continues its run, and a timer removes the series.
    """

    class AlertStates(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.before = handle.getValueState("before", "last long, since long")
            self.open = handle.getListState("open", "us long, value double, breach boolean")

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            mark = timerValues.getCurrentWatermarkInMs()
            kept = {us: (value, breach) for us, value, breach in self.open.get()} if self.open.exists() else {}
            late, new = [], []
            for frame in rows:
                frame = frame.sort_values(["at_us", "value", "breach"], na_position="first")
                for us, value, breach in zip(frame["at_us"], frame["value"], frame["breach"]):
                    value = None if pd.isna(value) else float(value)
                    breach = False if pd.isna(breach) else bool(breach)
                    if pd.isna(us) or int(us) // 1000 < mark:
                        late.append((None if pd.isna(us) else int(us), value, breach, None, None, True))
                    else:
                        kept[int(us)] = value, breach
                        new.append(int(us))
            out = late
            if new:
                out = out + self._advance(kept, min(new))
            names = ["at_us", "value", "breach", "since_us", "state", "late"]
            frame = pd.DataFrame(out, columns=names).astype({"at_us": "Int64", "since_us": "Int64"})
            for place, name in enumerate(series):
                frame.insert(place, name, [key[place]] * len(frame))
            yield frame

        def _advance(self, kept, first):
            last, since = self.before.get() if self.before.exists() else (None, None)
            newest = max(kept)
            out, open_ = [], []
            for us in sorted(kept):
                value, breach = kept[us]
                if not breach:
                    since = None
                elif since is None or last != us - step_s * 1_000_000:
                    since = us
                last = us
                if us >= first:
                    held = since is not None and us - since >= hold_s * 1_000_000
                    state = "inactive" if since is None else "firing" if held else "pending"
                    out.append((us, value, breach, since, state, False))
                # what the next watermark will have passed can get no neighbour any more
                if us // 1000 < newest // 1000 - late_s * 1000:
                    self.before.update((last, since))
                else:
                    open_.append((us, value, breach))
            self.open.put(open_)
            self.handle.registerTimer(newest // 1000 + step_s * 1000 + 1)
            return out

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            newest = max(us for us, _, _ in self.open.get()) if self.open.exists() else 0
            if newest // 1000 + step_s * 1000 < timerValues.getCurrentWatermarkInMs():
                self.open.clear()
                self.before.clear()
            return iter(())

        def close(self):
            pass

    return AlertStates()


def delivery_processor(send, backoff_ms: list[int], chunk: int = 2000) -> StatefulProcessor:
    """Attempts and repeated attempts, for ``transformWithStateInPandas`` over a ``shard`` of deliveries.

    Rows are ``body`` (text) and ``allowed`` (attempts). ``send`` takes a frame with ``body`` and
    ``attempt`` (from 1) of at most ``chunk`` rows and returns for each row whether it got through; an
    exception means that none did. Failed deliveries wait in the shard's state, in chunks by the time
    they are due, until a processing-time timer finds them: after the k-th attempt the k-th of
    ``backoff_ms``, then the last. Settled deliveries come out with ``attempts_made`` and
    ``delivered``. A task holds a few chunks at a time, however many deliveries a shard has.
    """

    class Deliveries(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.waiting = handle.getMapState(
                "chunks", "due long, part int", "bodies array<string>, allowed array<int>, attempts array<int>"
            )

        def handleInputRows(self, key, rows, timerValues):
            now, failed, parts = timerValues.getCurrentProcessingTimeInMs(), {}, {}
            for frame in rows:
                for at in range(0, len(frame), chunk):
                    part = frame.iloc[at : at + chunk]
                    new = [(b, int(a), 0) for b, a in zip(part["body"], part["allowed"])]
                    yield self._try(key, new, now, failed, parts)
            self._hold(failed, parts, 1)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now, failed, parts = timerValues.getCurrentProcessingTimeInMs(), {}, {}
            at = expiredTimerInfo.getExpiryTimeInMs(), 0
            while self.waiting.containsKey(at):
                held = list(zip(*self.waiting.getValue(at)))
                self.waiting.removeKey(at)
                yield self._try(key, held, now, failed, parts)
                at = at[0], at[1] + 1
            self._hold(failed, parts, 1)

        def _try(self, key, rows, now, failed, parts):
            import pandas as pd

            settled = []
            frame = pd.DataFrame({"body": [r[0] for r in rows], "attempt": [r[2] + 1 for r in rows]})
            try:
                through = [bool(x) for x in send(frame)]
            except Exception:  # a sink that is down fails all
                through = [False] * len(rows)
            if len(through) != len(rows):
                raise ValueError("send answers for each row")
            for (body, allowed, attempts), ok in zip(rows, through):
                made = attempts + 1
                if ok or made >= allowed:
                    settled.append((key[0], body, made, ok))
                else:
                    # later than the timer that is being served
                    wait = max(1, backoff_ms[min(made, len(backoff_ms)) - 1])
                    failed.setdefault(now + wait, []).append((body, allowed, made))
            self._hold(failed, parts, chunk)
            return pd.DataFrame(settled, columns=["shard", "body", "attempts_made", "delivered"])

        def _hold(self, failed, parts, least):
            """Put what has failed into the state, where there are ``least`` rows for one time."""
            for due, rows in failed.items():
                while len(rows) >= least:
                    if due not in parts:
                        parts[due] = 0
                        self.handle.registerTimer(due)
                    # other micro-batches may have chunks due at the same time
                    while self.waiting.containsKey((due, parts[due])):
                        parts[due] += 1
                    self.waiting.updateValue((due, parts[due]), tuple(list(c) for c in zip(*rows[:chunk])))
                    del rows[:chunk]

        def close(self):
            pass

    return Deliveries()
