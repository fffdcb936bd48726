"""Sources that may fall silent, and rows that came too late.

A window closes when the slowest of its sources has passed its end, and a source without
records passes nothing. A heartbeat is a record that carries a time only: it says that its
source has nothing older to come. Rows dropped for lateness all the same are counted in a
table.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tradewind.config import micros, span
from tradewind.operators.parse import parse_records

HEARTBEAT = "source string, ts bigint"
LATE_ROWS = "query string, run string, batch bigint, operator string, position int, dropped bigint, watermark string"


def parse_heartbeats(raw: DataFrame) -> DataFrame:
    """(source, rowtime) of heartbeat records; a null source means every source."""
    from pyspark.sql import types as T

    parsed = parse_records(raw, T.StructType.fromDDL(HEARTBEAT))
    return parsed.select("source", F.timestamp_millis("ts").alias("rowtime")).filter("rowtime IS NOT NULL")


def with_heartbeat(
    df: DataFrame, beats: DataFrame, source: str, delay: timedelta, time: str = "rowtime"
) -> DataFrame:
    """df with its watermark, which the heartbeats of ``source`` advance as well.

    They pass the watermark with the rows and are taken out behind it, so no operator
    sees them. A batch table has no watermark and is returned as it is.
    """
    if not df.isStreaming:
        return df
    own = beats.filter(F.col("source").isNull() | (F.col("source") == source))
    beat = own.select(F.col("rowtime").cast(df.schema[time].dataType).alias(time), F.lit(True).alias("_beat"))
    both = df.withColumn("_beat", F.lit(False)).unionByName(beat, allowMissingColumns=True)
    # The condition names the time: one that did not would be moved below the watermark.
    real = ~F.col("_beat") | F.col(time).isNull()
    return both.withWatermark(time, span(delay)).filter(real).drop("_beat")


def newest_times(sources: Mapping[str, DataFrame], allowance: timedelta, time: str = "rowtime") -> DataFrame:
    """Heartbeat records (value) for all sources out of one batch of each: the newest time
    seen anywhere, less how far a source may lag behind the others."""
    times = [df.select(F.col(time).alias("t")) for df in sources.values()]
    both = times[0]
    for more in times[1:]:
        both = both.unionByName(more)
    ts = F.expr(f"(unix_micros(max(t)) - {micros(allowance)}) div 1000")
    newest = both.agg(ts.alias("ts")).filter("ts IS NOT NULL")
    return newest.select(F.to_json(F.struct("ts")).alias("value"))


class LateRows(StreamingQueryListener):
    """Counts rows that stateful operators drop behind the watermark, in a table of its own.

    One small file for each batch that dropped any; a re-run batch writes its file again.
    An aggregation counts groups of a batch, other operators count rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._folder().mkdirs(self._hadoop(self.path))

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _folder(self):
        return self._hadoop(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def rows(self, progress) -> list[dict]:
        seen = dict(progress.eventTime or {})
        return [
            {
                "query": progress.name, "run": str(progress.runId), "batch": progress.batchId,
                "operator": op.operatorName, "position": at, "dropped": op.numRowsDroppedByWatermark,
                "watermark": seen.get("watermark"),
            }
            for at, op in enumerate(progress.stateOperators)
            if op.numRowsDroppedByWatermark
        ]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = self.rows(progress)
        if rows:
            path = f"{self.path}/{progress.id}-{progress.batchId}.json"
            text = "\n".join(json.dumps(r) for r in rows) + "\n"
            out = self._folder().create(self._hadoop(path), True)
            try:
                out.write(bytearray(text.encode()))
            finally:
                out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def settled(self) -> None:
        """Wait until the progress of ended queries has been heard."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def read(self) -> DataFrame:
        return self.spark.read.schema(LATE_ROWS).json(self.path)
