"""Written intermediate tables.

A derived table that several jobs read is written once as Parquet under the
folder the cluster names in ``spark.checkpoint.dir`` and read back: this cuts the
lineage, survives lost executors and keeps column pruning and partition pruning
for the readers.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="sessionweave-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession) -> str:
    """A path of this application in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/sessionweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """The same rows read back from a written copy: later uses all see one result."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The rows as a written table bucketed by ``column``: joins and groups on it do not move them again."""
    return df.sparkSession.table(_bucketed_table(df, column, partition_by)).select(*df.columns)


def _bucketed_table(df: DataFrame, column: str, partition_by: tuple[str, ...] = ()) -> str:
    spark = df.sparkSession
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), most)
    name = f"sessionweave_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, column).write.partitionBy(*partition_by).bucketBy(buckets, column).sortBy(column)
    writer.option("path", scratch_path(spark)).format("parquet").saveAsTable(name)
    return name


def _origin(df: DataFrame) -> int | None:
    """A number for the files a table is read from; None if it is read from none."""
    files = df.inputFiles()  # names only
    return hash(tuple(sorted(files))) if files else None


class Workspace:
    """Tables written by one job, by name.

    A workspace belongs to one log: a table made ``of`` a log is not handed out for
    another one. Close it, or use it in a ``with``, to remove what it wrote.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._tables: dict[str, tuple] = {}
        self._bucketed: dict[str, str] = {}
        self._values: dict[str, object] = {}
        self._origins: dict[str, int | None] = {}

    def keep(
        self,
        name: str,
        build: Callable[[], DataFrame],
        partition_by: tuple[str, ...] = (),
        of: DataFrame | None = None,
        bucket_by: str | None = None,
    ) -> DataFrame:
        """Table ``name``, built and written on first use; an error if it was made of another log than ``of``."""
        origin = None if of is None else _origin(of)
        if name not in self._tables:
            table, path = build(), scratch_path(self.spark)
            if bucket_by:
                self._bucketed[name] = _bucketed_table(table, bucket_by, partition_by)
                path = self._place(self._bucketed[name])
            else:
                table.write.partitionBy(*partition_by).parquet(path)
            self._tables[name] = (path, table.schema)
            self._origins[name] = origin
        elif self._origins[name] != origin and None not in (self._origins[name], origin):
            raise ValueError(f"table {name!r} of this workspace belongs to another log: use a workspace for each log")
        path, schema = self._tables[name]
        if name in self._bucketed:
            return self.spark.table(self._bucketed[name]).select(*schema.names)
        return self.spark.read.schema(schema).parquet(path)

    def _place(self, table: str) -> str:
        described = self.spark.sql(f"DESCRIBE FORMATTED {table}")
        return described.where("col_name = 'Location'").first().data_type

    def close(self) -> None:
        """Remove the tables written here; what was read from them cannot be used any more."""
        jvm = self.spark._jvm
        for table in self._bucketed.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path, _ in self._tables.values():
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self._tables.clear()
        self._bucketed.clear()
        self._origins.clear()
        self._values.clear()

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def remember(self, name: str, compute: Callable[[], object]) -> object:
        """A small driver-side value, computed on first use."""
        if name not in self._values:
            self._values[name] = compute()
        return self._values[name]


_SPACES: dict[str, Workspace] = {}


def application_space(spark: SparkSession) -> Workspace:
    """The workspace shared by all jobs of an application."""
    app = spark.sparkContext.applicationId
    if app not in _SPACES:
        _SPACES[app] = Workspace(spark)
    return _SPACES[app]


def written(
    spark: SparkSession, name: str, build: Callable[[], DataFrame], partition_by: tuple[str, ...] = (), bucket_by: str | None = None
) -> DataFrame:
    return application_space(spark).keep(name, build, partition_by, bucket_by=bucket_by)


def remembered(spark: SparkSession, name: str, compute: Callable[[], object]) -> object:
    return application_space(spark).remember(name, compute)
