"""Topics: named streams of text records, on Kafka or on a shared folder.

Both kinds give a DataFrame with a ``value`` text column, take rows with ``value`` (and
optionally ``topic``), and work for batch and streaming. A stream's position lives in
the query's checkpoint.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


class KafkaTopics:
    """Topics on a Kafka cluster. The sink is at-least-once: consumers de-duplicate."""

    def __init__(self, spark: SparkSession, brokers: str, **options: str):
        self.spark = spark
        self.options = {"kafka.bootstrap.servers": brokers, **options}

    def read_options(self, topic: str, starting: str = "earliest") -> dict[str, str]:
        return {**self.options, "subscribe": topic, "startingOffsets": starting}

    def write_options(self, topic: str | None = None) -> dict[str, str]:
        return {**self.options, **({"topic": topic} if topic else {})}

    @staticmethod
    def _text(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic", "partition", "offset", "timestamp",
        )

    def read(self, topic: str) -> DataFrame:
        reader = self.spark.read.format("kafka")
        return self._text(reader.options(**self.read_options(topic)).load())

    def stream(self, topic: str, starting: str = "earliest") -> DataFrame:
        reader = self.spark.readStream.format("kafka")
        return self._text(reader.options(**self.read_options(topic, starting)).load())

    def write(
        self, rows: DataFrame, topic: str | None = None, batch_id: int | None = None, job: str = ""
    ) -> None:
        """Write to ``topic``, or to the topic each row's own column names."""
        rows.write.format("kafka").options(**self.write_options(topic)).save()

    def write_stream(
        self, rows: DataFrame, topic: str, checkpoint: str, job: str = ""
    ) -> DataStreamWriter:
        return (
            rows.writeStream.format("kafka")
            .options(**self.write_options(topic))
            .option("checkpointLocation", checkpoint)
        )


class FolderTopics:
    """Topics as folders of text files, one record a line, under a shared root.

    The topic is a partition of the root, so a row-chosen topic is a partitioned write. Any
    number of jobs may share a topic, and each batch of a job reaches its readers once:

    - its files are written to a staging folder nobody reads;
    - one entry of the manifest, made by a rename, names them. From here the batch counts;
    - the named files move to their topics. A batch run again finds its entry and only moves
      what is still staged, so a reader never meets the same records under other names.

    A job is told apart by its streaming query (the id kept in the checkpoint) besides its
    name, so one that lost its checkpoint writes all again instead of being taken for a
    re-run. The file sink is not used: its log hides all that other jobs have written.
    """

    def __init__(self, spark: SparkSession, root: str, max_files: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.max_files = max_files

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return self._path(self.root).getFileSystem(conf)

    def path(self, topic: str) -> str:
        """The topic's folder, made if no job has written to it yet."""
        path = f"{self.root}/topic={topic}"
        self._files().mkdirs(self._path(path))
        return path

    def read(self, topic: str) -> DataFrame:
        reader = self.spark.read.option("recursiveFileLookup", "true")
        return reader.text(self.path(topic)).select("value")

    def stream(self, topic: str, starting: str = "earliest") -> DataFrame:
        """``starting`` is ``earliest``, ``latest`` or a time such as ``2021-01-01 00:00:00``.

        Only files written after that time are taken; ``latest`` means after this call,
        so a query that is to be restarted names the time itself.
        """
        reader = self.spark.readStream.option("recursiveFileLookup", "true")
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        lines = reader.text(self.path(topic))
        if starting != "earliest":
            since = datetime.now().astimezone().isoformat() if starting == "latest" else starting
            written = F.col("_metadata.file_modification_time")
            lines = lines.filter(written > F.lit(since).cast("timestamp"))
        return lines.select("value")

    def write(
        self, rows: DataFrame, topic: str | None = None, batch_id: int | None = None, job: str = "batch"
    ) -> None:
        """Write ``value`` rows to ``topic``, or to the topic each row's own column names.

        The first write of a (job, batch, topic) counts, later ones add nothing; without a
        batch number every call adds its rows.
        """
        batch_id = uuid.uuid4().hex if batch_id is None else batch_id
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        entry = f"{self.root}/_manifest/{job}/{query}/{batch_id}/{topic or 'chosen'}"
        files = self._files()
        if not files.exists(self._path(entry)):
            staged = f"{self.root}/_staged/{uuid.uuid4().hex}"
            named = rows.withColumn("topic", F.lit(topic)) if topic else rows
            named.select("value", "topic").write.partitionBy("topic").text(staged)
            self._publish(self._commit(entry, staged, f"job={job}/batch_id={batch_id}"))
        else:
            # The batch is still run to its end, as its state has to be kept.
            rows.write.format("noop").mode("overwrite").save()
            # A line for each file of one batch.
            self._publish([r.value for r in self.spark.read.text(entry).collect()])

    def _commit(self, entry: str, staged: str, place: str) -> list[str]:
        """Name the staged files in a manifest entry: source and target, a line each."""
        files, lines = self._files(), []
        found = files.listFiles(self._path(staged), True)
        while found.hasNext():
            source = found.next().getPath()
            if source.getName().startswith("part-"):
                folder = f"{self.root}/{source.getParent().getName()}/{place}"
                lines.append(f"{source.toString()}\t{folder}/{source.getName()}")
        made = self._path(f"{staged}/_entry")
        out = files.create(made, True)
        try:
            out.write(bytearray("\n".join(lines).encode()))
        finally:
            out.close()
        files.mkdirs(self._path(entry).getParent())
        if not files.rename(made, self._path(entry)):
            raise OSError(f"manifest entry {entry} was not made")
        return lines

    def _publish(self, lines: list[str]) -> None:
        """Move the files of an entry that are still staged to their topics."""
        files = self._files()
        for line in filter(None, lines):
            source, target = (self._path(p) for p in line.split("\t"))
            if files.exists(source):
                files.mkdirs(target.getParent())
                if not files.rename(source, target):
                    raise OSError(f"{source} was not moved to {target}")

    def write_stream(
        self, rows: DataFrame, topic: str, checkpoint: str, job: str = "stream"
    ) -> DataStreamWriter:
        def each(batch: DataFrame, batch_id: int) -> None:
            self.write(batch, topic, batch_id, job)

        return (
            rows.select("value")
            .writeStream.foreachBatch(each)
            .option("checkpointLocation", checkpoint)
        )


def declare_table(
    raw: DataFrame, name: str, schema: str, rowtime: str, delay: str
) -> DataFrame:
    """A topic as a SQL table: declared columns, a computed ``rowtime``, a watermark.

    ``schema`` is DDL, ``rowtime`` a SQL expression over its columns. Registers and
    returns the view ``name``.
    """
    from pyspark.sql import types as T

    from tradewind.operators.parse import parse_records

    columns = parse_records(raw, T.StructType.fromDDL(schema))
    table = columns.withColumn("rowtime", F.expr(rowtime)).withWatermark("rowtime", delay)
    table.createOrReplaceTempView(name)
    return table
