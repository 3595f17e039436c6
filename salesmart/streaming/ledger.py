"""The run ledger as a stateful stream: the latest state of every key.

Each key's state is its last entry by time and number.  Entries may come late,
again, or in any order: an entry that is not later than the state changes
nothing, so a re-delivered file is harmless.  The entries of a micro-batch are
reduced to one per key in every task before they are shuffled, so a key with a
third of all entries reaches its state as one row per task.

A key whose last entry is not a final one is *overdue* some time after it: a
timer, set with the entry and replaced by the next, reports it once (a file
that was started and never done).  Timers go by the clock and not by a
watermark, below which a stateful operator drops entries that come late.

The changes go to a folder per micro-batch, which a repeated batch overwrites;
``latest`` reads them back.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from salesmart.operators.ledger import latest_state
from salesmart.sinks.publish import path_exists

# executors need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries of a ledger stream: key, time, number (ties of time), status.
ENTRIES = "key long, ts timestamp, seq long, status string"
CHANGES = "key long, ts timestamp, seq long, status string, overdue boolean"
STATE = "ts timestamp, seq long, status string, timer long"
#: Settings that a session with state needs.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # timers by the clock would ask for one more batch for ever
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # on a local disk, the store needs the file system with checksums
    "fs.file.impl": "org.apache.hadoop.fs.LocalFileSystem",
}


def reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last entry of each key in every batch of rows (NULL keys are a key)."""
    for rows in batches:
        if len(rows):
            yield rows.sort_values(["ts", "seq"], kind="stable", na_position="first").groupby("key", dropna=False, sort=False).tail(1)


class Latest(StatefulProcessor):
    """Keeps a key's last entry; emits it when it changes, and once when it is overdue."""

    def __init__(self, final: tuple[str, ...], overdue_ms: int):
        self.final, self.overdue_ms = final, overdue_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("latest", STATE)

    @staticmethod
    def _later(a: tuple, b: tuple | None) -> bool:
        if b is None:
            return True
        return (a[0] is not None, a[0] or 0, a[1] if a[1] is not None else -1) > (b[0] is not None, b[0] or 0, b[1] if b[1] is not None else -1)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        old = self.state.get() if self.state.exists() else None
        best = None if old is None else (_ms(old[0]), old[1], old[2], old[0])
        changed = False
        for part in rows:
            for ts, seq, status in zip(part["ts"], part["seq"], part["status"]):
                ts = None if pd.isna(ts) else ts
                seq = None if pd.isna(seq) else int(seq)
                entry = (_ms(ts), seq, status, None if ts is None else ts.to_pydatetime())
                if self._later(entry, best):
                    best, changed = entry, True
        if not changed:
            return
        if old is not None and old[3]:
            self.handle.deleteTimer(old[3])
        timer = 0
        if best[0] is not None and best[2] not in self.final:
            timer = best[0] // 1000 + self.overdue_ms
            self.handle.registerTimer(timer)
        self.state.update((best[3], best[1], best[2], timer))
        yield self._row(key, best[3], best[1], best[2], False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        old = self.state.get() if self.state.exists() else None
        if old is not None and old[3] == expiredTimerInfo.getExpiryTimeInMs():
            self.state.update((old[0], old[1], old[2], 0))
            yield self._row(key, old[0], old[1], old[2], True)

    @staticmethod
    def _row(key: Any, ts: Any, seq: Any, status: Any, overdue: bool) -> pd.DataFrame:
        number = lambda x: pd.array([x], "Int64")
        return pd.DataFrame({"key": number(key[0]), "ts": pd.Series([ts], dtype="datetime64[us]"), "seq": number(seq), "status": [status], "overdue": [overdue]})

    def close(self) -> None:
        pass


def _ms(ts: Any) -> int | None:
    """Microseconds since the epoch."""
    return None if ts is None else int(pd.Timestamp(ts).value // 1000)


def changes(entries: DataFrame, final: tuple[str, ...], overdue: str = "30 days") -> DataFrame:
    """The stream of changed latest states of a stream of ENTRIES."""
    return entries.mapInPandas(reduced, ENTRIES).groupBy("key").transformWithStateInPandas(
        statefulProcessor=Latest(tuple(final), int(pd.Timedelta(overdue).total_seconds() * 1000)), outputStructType=CHANGES, outputMode="Update", timeMode="ProcessingTime"
    )


def start(spark: SparkSession, entries: Callable[[SparkSession], DataFrame], out_dir: str, checkpoint: str, final: tuple[str, ...], overdue: str = "30 days") -> StreamingQuery:
    """Process what is there and stop; the changes of each micro-batch replace ``batch_id=<n>`` of ``out_dir``.

    ``entries`` gives the stream of ENTRIES in a session of its own, which has
    the settings of the state store.
    """
    own = spark.newSession()
    for key, value in STATE_STORE.items():
        own.conf.set(key, value)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={number}")

    writer = changes(entries(own), final, overdue).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def latest(spark: SparkSession, out_dir: str) -> DataFrame:
    """``key, ts, seq, status, overdue`` of every key: its last change (in a micro-batch, timers come last)."""
    if not path_exists(spark, out_dir):
        return spark.createDataFrame([], CHANGES)
    spark.catalog.refreshByPath(out_dir)
    rows = spark.read.schema(CHANGES + ", batch_id long").parquet(out_dir)
    return latest_state(rows, "key", ["batch_id", "overdue"], ["ts", "seq", "status", "overdue"])
