"""Dimension tables: text columns, one row per primary key, upserted by change events."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.changes import upserted

#: Buckets of a new table; a table keeps the number it was made with.
BUCKETS = 64


class DimTable:
    """A dimension as images of hash buckets, and a pointer to each bucket's present image.

    A batch folds its changes into the buckets that hold their keys, writes those anew and
    then names them in a new pointer file, made by a rename. Neither a batch nor a lookup by
    keys costs more as the table's history grows, and a reader sees a batch whole or not at
    all. A batch run again finds itself in the pointer and changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        columns: Sequence[str],
        pk: str = "id",
        buckets: int = BUCKETS,
    ):
        if pk not in columns:
            raise ValueError(f"primary key {pk} is not among the columns of {name}")
        self.spark = spark
        self.path = f"{root.rstrip('/')}/sink_table={name}"
        self.name = name
        self.columns = list(columns)
        self.pk = pk
        self.buckets = buckets

    @classmethod
    def from_config(
        cls, spark: SparkSession, root: str, sink_table: str,
        sink_columns: str, sink_pk: str | None = None,
    ) -> DimTable:
        return cls(spark, root, sink_table, sink_columns.split(","), sink_pk or "id")

    # ---- the pointer -------------------------------------------------------------

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return self._path(self.path).getFileSystem(conf)

    def _versions(self) -> list[int]:
        files, folder = self._files(), self._path(f"{self.path}/_pointers")
        if not files.exists(folder):
            return []
        names = (f.getPath().getName() for f in files.listStatus(folder))
        return sorted(int(n) for n in names if n.isdigit())

    def _pointer(self) -> tuple[int, str, int, dict[int, str]]:
        """(version, the batch that made it, number of buckets, bucket to image folder)."""
        versions = self._versions()
        if not versions:
            return -1, "", self.buckets, {}
        stream = self._files().open(self._path(f"{self.path}/_pointers/{versions[-1]}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        batch, buckets, *lines = text.split("\n")
        folders = dict(line.split("\t") for line in lines if line)
        return versions[-1], batch, int(buckets), {int(b): folder for b, folder in folders.items()}

    def _point(self, version: int, batch: str, buckets: int, folders: Mapping[int, str]) -> None:
        files = self._files()
        lines = [batch, str(buckets), *(f"{b}\t{folder}" for b, folder in sorted(folders.items()))]
        made = self._path(f"{self.path}/_pointers/_{uuid.uuid4().hex}")
        out = files.create(made, True)
        try:
            out.write(bytearray("\n".join(lines).encode()))
        finally:
            out.close()
        if not files.rename(made, self._path(f"{self.path}/_pointers/{version}")):
            raise OSError(f"pointer {version} of {self.name} was not made")

    # ---- writing -----------------------------------------------------------------

    def create(self) -> DimTable:
        """Make the table if it is not there yet; it starts empty."""
        if not self._versions():
            self._point(0, "", self.buckets, {})
        return self

    def upsert(
        self, changes: DataFrame, batch_id: int, order: Sequence[str] = ()
    ) -> None:
        """Apply a batch of changes (``after`` map); ``order`` (whole numbers, most
        significant first) decides between changes of a key."""
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        version, last, buckets, folders = self._pointer()
        if last == f"{query}/{batch_id}":
            changes.write.format("noop").mode("overwrite").save()  # run to its end, for its state
            return
        seq = F.array(*(F.col(c).cast("bigint") for c in order)).cast("array<bigint>")
        text = F.transform_values("after", lambda _, v: v.cast("string"))
        key = F.try_element_at("after", F.lit(self.pk)).cast("string")
        new = changes.select(text.alias("after"), F.lit(True).alias("new"), seq.alias("seq"), bucket_of(key, buckets).alias("bucket"))
        new = new.filter("bucket IS NOT NULL")
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # as many as buckets at most
        if not touched:
            return
        image = F.map_from_arrays(
            F.array(*(F.lit(c) for c in self.columns)), F.array(*(F.col(c) for c in self.columns))
        )
        old = self._rows({b: folders[b] for b in touched if b in folders}).select(
            image.alias("after"), F.lit(False).alias("new"), F.array().cast("array<bigint>").alias("seq")
        )
        rows = upserted(old.unionByName(new.drop("bucket")), self.pk, self.columns, ("new", "seq"))
        folder = f"images/{uuid.uuid4().hex}"
        self._write(rows, folder, buckets)
        self._point(version + 1, f"{query}/{batch_id}", buckets, folders | dict.fromkeys(touched, folder))

    def _write(self, rows: DataFrame, folder: str, buckets: int) -> None:
        placed = rows.withColumn("bucket", bucket_of(F.col(self.pk), buckets))
        placed.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")

    def copy(self, root: str, buckets: int | None = None) -> DimTable:
        """The present rows as a new table under ``root``, which may have other buckets."""
        fresh = DimTable(self.spark, root, self.name, self.columns, self.pk, buckets or self._pointer()[2])
        folder, rows = f"images/{uuid.uuid4().hex}", self.read()
        fresh._write(rows, folder, fresh.buckets)
        held = rows.select(bucket_of(F.col(self.pk), fresh.buckets).alias("bucket")).distinct().collect()
        fresh._point(0, "", fresh.buckets, {r.bucket: folder for r in held})
        return fresh

    def clean(self) -> None:
        """Remove images and pointers that the present pointer does not name. Not to be called
        while a reader works on an earlier one."""
        version, _, _, folders = self._pointer()
        files, named = self._files(), {f.split("/")[-1] for f in folders.values()}
        for own in files.listStatus(self._path(f"{self.path}/images")) if folders else []:
            if own.getPath().getName() not in named:
                files.delete(own.getPath(), True)
                continue
            for part in files.listStatus(own.getPath()):  # buckets that were written anew since
                number = part.getPath().getName().partition("bucket=")[2]
                if number and folders.get(int(number)) != f"images/{own.getPath().getName()}":
                    files.delete(part.getPath(), True)
        for old in self._versions():
            if old < version:
                files.delete(self._path(f"{self.path}/_pointers/{old}"), False)

    # ---- reading -----------------------------------------------------------------

    def _rows(self, folders: Mapping[int, str]) -> DataFrame:
        schema = ", ".join(f"`{c}` string" for c in self.columns)
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{folder}/bucket={b}" for b, folder in sorted(folders.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, only: DataFrame | None = None) -> DataFrame:
        """The present rows; ``only`` (one key column) limits them to the keys it holds.

        With ``only``, just the buckets that hold those keys are read, which is what a
        lookup for one micro-batch wants.
        """
        _, _, buckets, folders = self._pointer()
        if only is None:
            return self._rows(folders)
        wanted = only.select(F.col(only.columns[0]).cast("string").alias("_wanted"))
        needed = wanted.select(bucket_of(F.col("_wanted"), buckets).alias("bucket")).distinct().collect()
        rows = self._rows({r.bucket: folders[r.bucket] for r in needed if r.bucket in folders})
        return rows.join(wanted, F.col(self.pk) == F.col("_wanted"), "left_semi")


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key; null for none."""
    return F.when(key.isNotNull(), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


class StoredDims:
    """Dimension tables by the names that jobs know them by.

    ``keys`` names the fact column that looks a table up; a job reads such a table for the
    keys of its batch only, and the others whole.
    """

    def __init__(self, tables: Mapping[str, DimTable], keys: Mapping[str, str]):
        self.tables, self.keys = dict(tables), dict(keys)

    def __call__(self, batch: DataFrame | None = None) -> dict[str, DataFrame]:
        own = set(batch.columns) if batch is not None else set()
        return {
            name: table.read(batch.select(self.keys[name]).distinct()) if self.keys.get(name) in own else table.read()
            for name, table in self.tables.items()
        }


def read_jdbc(spark: SparkSession, options: dict[str, str], table: str) -> DataFrame:
    """A table over JDBC; filters and column choice are pushed to the server."""
    return spark.read.format("jdbc").options(**options, dbtable=table).load()
