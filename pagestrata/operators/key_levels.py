"""Which keys a growing table has, kept in levels of tables bucketed by key.

Every run adds one small table of keys; tables of one level are merged into one
of the next, so a key is rewritten a logarithmic number of times and a look-up
meets few tables. All are bucketed alike: a look-up brings its own keys to the
buckets, and nothing of the tables is shuffled.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.schema import SEQ

#: ``kind`` tells keys of several rules apart; ``gone`` marks the key of a row that was removed.
KEYS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("seq", SEQ),
        T.StructField("gone", T.BooleanType()),
    ]
)


def _register(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> str:
    name = f"levels_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """A table bucketed by ``key``, one file for each bucket; it is in no catalog afterwards.

    Buckets are sorted by kind, where rows have one, and key: a look-up asks for one kind and skips the pages of the others.
    """
    name = f"levels_{uuid.uuid4().hex}"
    dealt = rows.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(*[c for c in ("kind", key) if c in rows.columns]).option("path", path).saveAsTable(name)
    rows.sparkSession.sql(f"DROP TABLE {name}")  # external: the files stay


class KeyLevels:
    """The tables of one version, opened by path; names leave the catalog when the ``with`` block ends."""

    def __init__(self, spark: SparkSession, paths: list[str], buckets: int):
        self.spark, self.paths, self.buckets = spark, paths, buckets
        self.names: list[str] = []

    def __enter__(self) -> KeyLevels:
        self.names = [_register(self.spark, p, KEYS, "key", self.buckets) for p in self.paths]
        return self

    def __exit__(self, *_) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []

    def having(self, keys: DataFrame, kind: str) -> DataFrame:
        """Rows ``(key, seq)`` that the table has under any of ``keys(key)``; removed ones do not count."""
        asked = keys.select("key").distinct()
        met = [self.spark.table(n).where(F.col("kind") == kind).join(asked, "key", "left_semi") for n in self.names]
        if not met:
            return self.spark.createDataFrame([], KEYS).select("key", "seq")
        every = reduce(DataFrame.unionByName, [m.select("key", "seq", "gone") for m in met])
        # Only what was met is dealt out anew. By position, as a union of bucketed tables is no bucketed table.
        every = every.withColumn("at", F.hash("key", "seq"))
        live = every.groupBy("at", "key", "seq").agg(F.max("gone").alias("gone"))
        return live.where(~F.col("gone")).select("key", "seq")


def merged(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The rows of several tables; the key of a removed row goes where both its entries meet."""
    rows = spark.read.schema(KEYS).parquet(*paths)  # as plain files, whose union Spark does not take for bucketed
    return (
        rows.groupBy("kind", "key", "seq")
        .agg(F.max("gone").alias("gone"), F.count(F.lit(1)).alias("n"))
        .where(~F.col("gone") | (F.col("n") == 1))
        .select("kind", "key", "seq", "gone")
    )
