"""Result tables, and a shared folder for intermediate ones."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class ResultStore:
    """Named Parquet tables below one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def write(
        self,
        df: DataFrame,
        name: str,
        sort_by: Sequence[str] = (),
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """Write ``df`` as ``name`` and return the written table.

        ``sort_by`` sorts inside each file, without a shuffle, so that row-group
        statistics narrow later look-ups by these columns. Reading the table back
        drops the lineage of ``df`` and gives the planner its true size.
        """
        rows = df.sortWithinPartitions(*sort_by) if sort_by else df
        writer = rows.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{name}")
        # The schema is known, so reading back needs no footer inspection job.
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")


class TableStore:
    """Named tables of a catalog database, optionally bucketed for later joins.

    Buckets are for tables that are joined as they are. A cohort is reduced to distinct persons first,
    which shuffles it whatever its buckets.
    """

    def __init__(self, spark: SparkSession, database: str, buckets: int = 0) -> None:
        self.spark = spark
        self.database = database
        self.buckets = buckets

    def write(
        self,
        df: DataFrame,
        name: str,
        sort_by: Sequence[str] = (),
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """As :meth:`ResultStore.write`; with buckets, one file per bucket of the first sort column."""
        rows, bucketed = df, bool(self.buckets and sort_by)
        if bucketed:
            # Otherwise every task would write a file of every bucket.
            rows = rows.repartition(self.buckets, sort_by[0])
        elif sort_by:
            rows = rows.sortWithinPartitions(*sort_by)
        writer = rows.write.mode("overwrite").format("parquet")
        if bucketed:
            writer = writer.bucketBy(self.buckets, sort_by[0]).sortBy(*sort_by)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(f"{self.database}.{name}")
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")


class Workspace(ResultStore):
    """Intermediate tables of one run, in the folder all executors share.

    A written table survives the loss of any executor, unlike a cached one whose
    blocks have to be recomputed through the whole lineage. ``close`` frees the space; what is not
    closed is removed when the application ends.
    """

    _open: ClassVar[list[Workspace]] = []

    @classmethod
    def close_all(cls) -> None:
        """Close whatever was opened in this process and isn't read any more."""
        while cls._open:
            cls._open[-1].close()

    @classmethod
    @contextmanager
    def scope(cls) -> Iterator[None]:
        """Close at the end what was opened within; for work whose result is written elsewhere."""
        before = list(cls._open)
        try:
            yield
        finally:
            for workspace in [w for w in cls._open if w not in before]:
                workspace.close()

    def __init__(self, spark: SparkSession) -> None:
        super().__init__(spark, f"{shared_folder(spark)}/cohortry-{uuid.uuid4().hex}")
        self._open.append(self)
        self._kept: dict[str, StructType] = {}
        if found := self._folder():
            path, files = found
            files.mkdirs(path)
            files.deleteOnExit(path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self._kept[name] = df.schema
        return self.write(df, name)

    def drop(self, name: str) -> None:
        """Remove one table; DataFrames read from it can't be used any more."""
        if found := self._folder():
            path, files = found
            files.delete(path.suffix(f"/{name}"), True)
            self._kept.pop(name, None)

    def close(self) -> None:
        """Remove the tables; DataFrames read from them can't be used any more."""
        if found := self._folder():
            path, files = found
            files.delete(path, True)
        else:  # a remote session can't delete files, but it can leave them without rows
            for name, schema in self._kept.items():
                empty = self.spark.createDataFrame([], schema)
                empty.write.mode("overwrite").parquet(f"{self.root}/{name}")
        self._kept.clear()
        if self in self._open:
            self._open.remove(self)

    def _folder(self):
        """The folder and its file system, in a session that has them."""
        context = getattr(self.spark, "sparkContext", None)
        if not context:
            return None
        path = context._jvm.org.apache.hadoop.fs.Path(self.root)
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())


#: How an operator stores rows that it reads more than once.
Keep = Callable[[DataFrame, str], DataFrame]


def keep_aside(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` in a workspace of its own, which is removed when the application ends."""
    return Workspace(df.sparkSession).keep(df, name)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder or, where none is set, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
