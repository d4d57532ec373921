"""A daily quota kept by a stream, with back-off after refusals."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

REFUSED = 429
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


class DailyQuota(StatefulProcessor):
    """By key: what each open local day has spent, and until when calls wait after a refusal.

    A timer at a day's end (in event time) drops its counter, so the state holds the
    days that the watermark leaves open.
    """

    def __init__(self, budget: float, first_wait: float, longest_wait: float):
        self.budget, self.first_wait, self.longest_wait = budget, first_wait * 1000, longest_wait * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day_end long", "spent double")
        self.pause = handle.getValueState("pause", "until double, refusals int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        f = pd.concat(rows).sort_values(["ms", "id"], kind="stable")
        watermark = timerValues.getCurrentWatermarkInMs()
        until, refusals = self.pause.get() if self.pause.exists() else (0.0, 0)
        spent: dict[int, float] = {}
        out: list[tuple[float | None, bool, str | None]] = []
        for ms, day_end, cost, status in zip(f["ms"], f["day_end"], f["cost"], f["status"]):
            day_end = int(day_end)
            if day_end <= watermark:
                out.append((None, False, "late"))
                continue
            if ms < until:
                out.append((None, False, "backoff"))
                continue
            if day_end not in spent:
                known = self.days.containsKey((day_end,))
                spent[day_end] = self.days.getValue((day_end,))[0] if known else 0.0
                if not known:
                    self.handle.registerTimer(day_end)
            spent[day_end] += cost
            planned = spent[day_end] <= self.budget
            out.append((spent[day_end], planned, None if planned else "quota"))
            if status == REFUSED:
                until, refusals = ms + min(self.first_wait * 2.0**refusals, self.longest_wait), refusals + 1
            elif planned:
                refusals = 0
        for day_end, total in spent.items():
            self.days.updateValue((day_end,), (total,))
        self.pause.update((float(until), int(refusals)))
        f = f.drop(columns=["ms", "id", "day_end", "cost", "status"])
        f["running"] = pd.array([None if r is None else r for r, _, _ in out], dtype="Float64")
        f["planned"], f["reason"] = [p for _, p, _ in out], [why for _, _, why in out]
        yield f

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        if self.days.containsKey((end,)):
            self.days.removeKey((end,))
        yield from ()

    def close(self) -> None:
        pass


@contextmanager
def state_store(spark: SparkSession):
    """The state store that such processors need, for the streams started within."""
    before = spark.conf.get(_STATE_STORE, None)
    spark.conf.set(_STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(_STATE_STORE) if before is None else spark.conf.set(_STATE_STORE, before)


def planned_calls(calls: DataFrame, keys: list[str], ts: str, id_col: str, cost: str, budget: float, status: str | None = None, late: str = "1 hour", first_wait: float = 1.0, longest_wait: float = 3600.0, zone: str = "America/Lima") -> DataFrame:
    """The stream's rows with ``running`` (the day's cost with the row's own), ``planned`` (within the budget) and ``reason``.

    The stream's relative of `state.planned`: equal to it on the same calls if none is late and none is refused.
    By key, calls go in the order of time, then id, within a micro-batch; batches go in the order of their arrival. A call whose ``status`` is 429
    makes those of the next ``first_wait`` seconds wait (reason ``backoff``, they cost nothing), twice as long after each
    further refusal, up to ``longest_wait``; a planned call that is not refused ends that. Calls of a day that the
    watermark has closed have the reason ``late``. Null costs count as zero, calls without a time are left out.

    A key's rows of one micro-batch are sorted in memory; the source's own limit by trigger (files, offsets) bounds them.
    """
    local = F.from_utc_timestamp(F.col(ts), zone)
    day_end = F.unix_millis(F.to_utc_timestamp(F.date_add(F.to_date(local), 1).cast("timestamp"), zone))
    names = {c: f"c{i}" for i, c in enumerate(calls.columns)}  # frames change names that begin with an underscore
    rows = calls.filter(F.col(ts).isNotNull()).withWatermark(ts, late).select(
        *(F.col(f"`{c}`").alias(n) for c, n in names.items()), (F.unix_micros(ts) / 1000.0).alias("ms"), F.col(id_col).alias("id"), day_end.alias("day_end"),
        F.coalesce(F.col(cost).cast("double"), F.lit(0.0)).alias("cost"), (F.coalesce(F.col(status).cast("int"), F.lit(0)) if status else F.lit(0)).alias("status"),
    )
    own = [StructField(names[f.name], f.dataType) for f in calls.schema.fields]
    added = [StructField("running", DoubleType()), StructField("planned", BooleanType()), StructField("reason", StringType())]
    kept = rows.groupBy(*(names[k] for k in keys)).transformWithStateInPandas(DailyQuota(budget, first_wait, longest_wait), StructType(own + added), "Append", "EventTime")
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()), "running", "planned", "reason")
