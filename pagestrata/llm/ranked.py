"""Gapless positions of rows in groups of any size."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.sources.tables import Staging


def _numbered_runs(batches):
    """Adds the number of each row within its run of equal ``gkey``; rows come in order."""
    last, count = None, 0
    for batch in batches:
        keys, n = batch.column("gkey"), batch.num_rows
        if n == 0:
            continue
        starts = [0] if last is None or keys[0].as_py() != last else []
        changed = pc.not_equal(keys.slice(1), keys.slice(0, n - 1))
        starts += [k + 1 for k in pc.indices_nonzero(changed).to_pylist()]
        at = pa.array(range(n), pa.int64())
        if not starts:
            local = pc.add(at, count)
        else:
            pieces = [pa.array(range(count, count + starts[0]), pa.int64())] if starts[0] else []
            for a, b in zip(starts, [*starts[1:], n]):
                pieces.append(pa.array(range(b - a), pa.int64()))
            local = pa.concat_arrays(pieces)
        last, count = keys[n - 1].as_py(), local[n - 1].as_py() + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, local], names=[*batch.schema.names, "local"])


def ranked(rows: DataFrame, order: list[str], staging: Staging, name: str) -> DataFrame:
    """``rows`` with ``pos``: 0, 1, 2, ... within each ``gkey`` (a string, not null), nulls of ``order`` first.

    Rows are cut into ranges of about equal size by group, order and place in the
    input, so neither a large group nor equal rows fill one task. A range numbers
    its own rows; only the group with which it begins can have rows before it, so
    what is added is one number for each range.
    """
    by = [F.col("gkey"), *[F.col(c).asc_nulls_first() for c in order], F.col("_tie")]
    cut = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    cut = cut.drop("_tie").withColumn("part", F.spark_partition_id())
    schema = T.StructType([*cut.schema.fields, T.StructField("local", T.LongType())])
    stored = staging.store(cut.mapInArrow(_numbered_runs, schema), name)
    before = Window.partitionBy("gkey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy("gkey", "part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("gkey", "part", F.sum("n").over(before).alias("offset")).where("offset > 0")
    # At most one row for each range.
    out = stored.join(F.broadcast(offsets), ["gkey", "part"], "left")
    return out.withColumn("pos", F.col("local") + F.coalesce("offset", F.lit(0))).drop("part", "local", "offset")
