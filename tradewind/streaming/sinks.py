"""Writers for streaming results."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tradewind.session import run_dir

BatchWriter = Callable[[DataFrame, int], None]


def write_routes(
    batch: DataFrame, batch_id: int, routes: Mapping[str, BatchWriter], column: str = "route"
) -> None:
    """One pass, several outputs: compute a batch once, then write each route's rows."""
    batch = batch.persist()
    try:
        for route, write in routes.items():
            write(batch.filter(F.col(column) == route), batch_id)
    finally:
        batch.unpersist()


def table_writer(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append final rows to a parquet table; exactly once per checkpoint."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def jdbc_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows for a database table, by name; columns the table lacks are left out."""
    return df.select(*columns)


def jdbc_writer(
    options: Mapping[str, str], table: str, columns: Sequence[str], batch_size: int = 1000
) -> BatchWriter:
    """Insert each batch over JDBC. At-least-once: a re-run batch is inserted again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            jdbc_columns(batch, columns)
            .write.format("jdbc")
            .options(**options, dbtable=table, batchsize=str(batch_size))
            .mode("append")
            .save()
        )

    return write


class RefinedTable:
    """A statistics table whose rows late data may refine (update mode), folded as it grows.

    Rows that can still be refined are kept in one open part; a batch folds its refinements
    into it, the newest state of a key standing for it. Rows that the batch says are closed
    move to the final part and are never looked at again, so neither a batch nor the folding
    costs more than the open rows. A small state file, made by a rename, names the batch, its
    part and the one before; a batch run again starts from that one and replaces itself, and
    a move that a crash cut short is finished by the next batch.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return self._path(self.path).getFileSystem(conf)

    def _state(self) -> tuple[int, str, str, str, str]:
        """(version, the batch that made it, its part, the part before, the part it replaced)."""
        files, folder = self._files(), self._path(f"{self.path}/_states")
        found = files.listStatus(folder) if files.exists(folder) else []
        names = [f.getPath().getName() for f in found]
        version = max((int(n) for n in names if n.isdigit()), default=-1)
        if version < 0:
            return -1, "", "", "", ""
        return version, *read_text(self.spark, f"{self.path}/_states/{version}").split("\n")

    def write(self, batch: DataFrame, batch_id: int, closed: Column | None = None) -> None:
        """Fold a batch in; ``closed`` tells which rows no later batch can refine."""
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        version, last, part, before, replaced = self._state()
        self._finish(part, replaced)
        again = last == f"{query}/{batch_id}"
        base = before if again else part
        rows = batch.withColumn("_new", F.lit(True))
        held = self._existing(f"{self.path}/_parts/{base}/closed=false") if base else None
        if held is not None:
            rows = rows.unionByName(held.withColumn("_new", F.lit(False)))
        values = [c for c in batch.columns if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "_new").alias("_row"))
        newest = newest.select(*self.keys, "_row.*").select(*batch.columns)
        done = F.lit(False) if closed is None else F.coalesce(closed, F.lit(False))
        made, gone = f"p{uuid.uuid4().hex}", part if again else ""
        newest.withColumn("closed", done).write.partitionBy("closed").parquet(f"{self.path}/_parts/{made}")
        state = "\n".join([f"{query}/{batch_id}", made, base, gone])
        write_text(self.spark, f"{self.path}/_states/{version + 1}", state)
        self._finish(made, gone)
        for old in {part, before} - {base, ""}:
            self._files().delete(self._path(f"{self.path}/_parts/{old}"), True)
        if version >= 0:
            self._files().delete(self._path(f"{self.path}/_states/{version}"), False)

    def _finish(self, part: str, replaced: str) -> None:
        """Move a named part's closed rows to the final part, in place of those it replaced."""
        files = self._files()
        if replaced:
            files.delete(self._path(f"{self.path}/final/part={replaced}"), True)
        staged = self._path(f"{self.path}/_parts/{part}/closed=true")
        if part and files.exists(staged):
            files.mkdirs(self._path(f"{self.path}/final"))
            if not files.rename(staged, self._path(f"{self.path}/final/part={part}")):
                raise OSError(f"{staged.toString()} was not moved")

    def _existing(self, folder: str) -> DataFrame | None:
        if not self._files().exists(self._path(folder)):
            return None
        return self.spark.read.parquet(folder)

    def read(self, only_closed: bool = False) -> DataFrame:
        """The table's rows: the closed ones, and those still open unless ``only_closed``."""
        _, _, part, _, replaced = self._state()
        final = self._existing(f"{self.path}/final")
        if final is not None:
            final = final.filter(F.col("part").cast("string") != replaced).drop("part")
        kinds = ["true"] if only_closed else ["true", "false"]  # closed rows that were not moved yet
        parts = [final, *(self._existing(f"{self.path}/_parts/{part}/closed={k}") for k in kinds if part)]
        found = [df for df in parts if df is not None]
        if not found:
            raise ValueError(f"{self.path} holds no such rows yet")
        return reduce(DataFrame.unionByName, found)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file of the shared folder."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears whole, by a rename; it must not be there yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = files.create(made, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not files.rename(made, target):
        raise OSError(f"{path} was not made")


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> datetime:
    """The watermark that a query's batch runs under, out of its offset log; rows of windows
    that end by it can come no more."""
    lines = read_text(spark, f"{checkpoint}/offsets/{batch_id}").split("\n")
    return datetime.fromtimestamp(json.loads(lines[1])["batchWatermarkMs"] / 1000, timezone.utc)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write rows to a folder, in place of what a run before this left there, and read them."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def console(df: DataFrame, checkpoint: str) -> DataStreamWriter:
    """Print rows; for looking at a job, not for keeping its result."""
    return (
        df.writeStream.format("console")
        .outputMode("append")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
    )


def run_available(df: DataFrame, purpose: str, checkpoint: str | None = None) -> DataFrame:
    """Run a streaming result over all input there is now and read what it emitted."""
    spark = df.sparkSession
    base = run_dir(spark, purpose)
    query = (
        table_writer(df, f"{base}/out", checkpoint or f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    finish(query)
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def finish(query: StreamingQuery) -> None:
    """Wait for a bounded query; raises if it failed."""
    query.awaitTermination()


def with_restarts(
    start: Callable[[], StreamingQuery], restarts: int = 3, pause: float = 5.0
) -> None:
    """Run a query to its end, starting it again from its checkpoint if it fails."""
    for attempt in range(restarts + 1):
        try:
            finish(start())
            return
        except StreamingQueryException:
            if attempt == restarts:
                raise
            time.sleep(pause)
