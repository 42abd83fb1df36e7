"""As-of lookup on streams: snapshots kept in state, questions answered when the watermark passes.

Snapshots (key, position, value) and questions (key, position, what to call the
answer) travel in one stream whose event time is the position, one second per
block.  A question waits until the watermark has passed its position, since
a snapshot at or before it may still come; then the latest snapshot at
or before it is its answer.  Of the snapshots behind the watermark only the
newest of each key is kept, so state holds the allowed lateness and one row more.

The key's last snapshot of all, the fallback of questions without an earlier
one, is kept as a table of its own, as it may still change after the answer.
"""

from __future__ import annotations

import os
import sys
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidepool.operators import upsert as U
from tidepool.streaming.open_windows import STATE_STORE

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = ("chain_id", "token", "owner")
# One stream: ``name`` is null for a snapshot, ``value`` for a question.
ROW = "chain_id long, token string, owner string, position long, value string, name string"
OUT = "chain_id long, token string, owner string, name string, position long, value string, latest boolean"


class AsOf(StatefulProcessor):
    def init(self, handle) -> None:
        self.handle = handle
        self.snapshots = handle.getValueState("snapshots", "at array<long>, value array<string>")
        self.questions = handle.getValueState("questions", "at array<long>, name array<string>")

    def _load(self, state) -> list:
        got = state.get() if state.exists() else None
        return list(zip(got[0], got[1])) if got else []

    def _answer(self, key, snaps: list, asked: list, watermark: int, latest) -> Iterator[pd.DataFrame]:
        """Answer what the watermark has passed, store the rest, and wake up for the next."""
        at = [p for p, _ in snaps]
        ready = [(p, n) for p, n in asked if p * 1000 < watermark]
        waiting = [(p, n) for p, n in asked if p * 1000 >= watermark]
        out = [(n, p, snaps[i - 1][1] if i else None, False) for p, n in ready for i in (bisect_right(at, p),)]
        if latest is not None:
            out.append((None, *latest, True))
        # Waiting and future questions lie behind the watermark: of the snapshots before it the newest will do.
        first = max(bisect_right(at, (watermark - 1) // 1000) - 1, 0) if watermark > 0 else 0
        snaps = snaps[first:]
        self.snapshots.update(([p for p, _ in snaps], [v for _, v in snaps]))
        self.questions.update(([p for p, _ in waiting], [n for _, n in waiting]))
        if waiting:
            self.handle.registerTimer(min(p for p, _ in waiting) * 1000 + 1)
        if out:
            name, position, value, last = zip(*out)
            yield pd.DataFrame({"chain_id": [key[0]] * len(out), "token": [key[1]] * len(out), "owner": [key[2]] * len(out), "name": name,
                                "position": pd.array(position, dtype="Int64"), "value": value, "latest": last})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        snaps, asked, new = self._load(self.snapshots), self._load(self.questions), []
        for pdf in rows:
            for p, v, n in zip(pdf["position"].tolist(), pdf["value"].tolist(), pdf["name"].tolist()):
                if n is None:
                    new.append((int(p), v))
                else:
                    asked.append((int(p), n))
        # Of snapshots at one position the largest value counts, as in the batch join.
        best: dict = {}
        for p, v in snaps + new:
            best[p] = v if p not in best or v > best[p] else best[p]
        snaps = sorted(best.items())
        yield from self._answer(key, snaps, asked, timerValues.getCurrentWatermarkInMs(), snaps[-1] if new else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._answer(key, self._load(self.snapshots), self._load(self.questions),
                                timerValues.getCurrentWatermarkInMs(), None)

    def close(self) -> None:
        pass


def start_asof(spark: SparkSession, rows: DataFrame, work_dir: str, positions_late: int, available_now: bool = True) -> StreamingQuery:
    """Answer the questions in ``rows`` (ROW) into versions of ``work_dir``/answers and ``work_dir``/latest."""
    timed = rows.withColumn("event_time", F.timestamp_seconds("position")).withWatermark("event_time", f"{int(positions_late)} seconds")
    found = timed.groupBy(*KEY).transformWithStateInPandas(AsOf(), OUT, outputMode="update", timeMode="eventTime")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            U.write_version(batch.where("NOT latest").drop("latest"), os.path.join(work_dir, "answers"), batch_id)
            last = batch.where("latest").select(*KEY, "position", "value")
            U.write_version(last, os.path.join(work_dir, "latest"), batch_id)
        finally:
            batch.unpersist()
    conf, key = spark.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key, None)
    writer = found.writeStream.outputMode("update").foreachBatch(sink).option(
        "checkpointLocation", os.path.join(work_dir, "asof-checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    conf.set(key, STATE_STORE)
    try:
        return writer.start()
    finally:
        conf.set(key, before) if before else conf.unset(key)


def read_answers(spark: SparkSession, work_dir: str) -> DataFrame:
    """KEY, name, value (null: no snapshot at or before), latest_value: every question that was answered."""
    answers = spark.read.parquet(os.path.join(work_dir, "answers")).select(*KEY, "name", "value")
    last = spark.read.parquet(os.path.join(work_dir, "latest")).groupBy(*KEY).agg(
        F.max_by("value", F.struct("position", "batch_id")).alias("latest_value"))
    return answers.join(last, list(KEY), "left")
