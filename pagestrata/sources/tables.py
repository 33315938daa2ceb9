"""Reading pages and the base; where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.operators.dedupe import align_columns, empty_as_null
from pagestrata.schema import COLUMNS, PAGES, RECORDS
from pagestrata.sources.nodes import numbered


#: Session setting: number of partitions over which scans of whole texts are dealt. Unset: as the files are split.
SCAN_PARTITIONS = "spark.pagestrata.scan.partitions"


def dealt(scan: DataFrame) -> DataFrame:
    """A scan over as many partitions as SCAN_PARTITIONS says, for inputs of a few unsplittable files."""
    parts = scan.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return scan.repartition(int(parts)) if parts else scan


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table ``pages(page_id, url, html)``.

    Reading markup is bound by CPU: small splits (``spark.sql.files.maxPartitionBytes``
    of 16 to 32 MB, and row groups no larger) keep all cores at work.
    """
    return dealt(spark.read.schema(PAGES).parquet(path))


def read_page_files(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of HTML files as ``pages``, as the bytes they are; the file path is the URL.

    Page ids come from split and position, so they are unique in this scan (a
    hash of the path would not be, over billions of files) and the same when a
    task is repeated. A new scan may number differently: store the result to
    keep ids, and number the union of two scans anew.
    """
    files = spark.read.format("binaryFile").load(folder)
    return numbered(files.select(F.col("path").alias("url"), F.col("content").alias("html"))).select("page_id", "url", "html")


def read_or_empty(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """A parquet table with a known schema; no rows when the path does not exist yet."""
    if path is not None:
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


def read_base(spark: SparkSession, path: str | None, empty_is_null: bool = True) -> DataFrame:
    """The accumulated base, aligned; empty cells read as null unless told otherwise."""
    base = align_columns(read_or_empty(spark, path, RECORDS), COLUMNS, keep=("seq",))
    return empty_as_null(base) if empty_is_null else base


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where none is named, a folder of the warehouse, which is shared by definition.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged").rstrip("/")


class Staging:
    """Stores intermediate tables of one run in the shared folder, each under a fresh path.

    A stored table cuts lineage, survives the loss of executors and, unlike a
    checkpoint, keeps column pruning and filter pushdown for its readers. The
    tables go when ``drop`` is called or the ``with`` block ends, and at the
    latest when the driver ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/pagestrata/{uuid.uuid4().hex}"
        path, fs = self._path(self.folder)
        fs.deleteOnExit(path)

    def _path(self, folder: str):
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(sc._jsc.hadoopConfiguration())

    def store(self, df: DataFrame, name: str, **options) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("errorifexists").options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str | None = None) -> None:
        """Remove one table, or all of them."""
        path, fs = self._path(self.folder if name is None else f"{self.folder}/{name}")
        fs.delete(path, True)

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *_) -> None:
        self.drop()
