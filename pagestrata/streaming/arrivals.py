"""Run the job on pages as they arrive in a folder."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.plans import daily_run, items
from pagestrata.schema import PAGES, Labels
from pagestrata.sources.nodes import NODES, check_page_ids, explode_nodes
from pagestrata.sources.tables import Staging, read_or_empty


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that a stream keeps in its checkpoint; a new checkpoint is another stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _prefix(stream: str) -> str:
    return f"stream {stream} up to batch "


def _last_done(spark: SparkSession, out_dir: str, stream: str) -> int:
    """Last batch of the stream that a finished run has."""
    done = [r for _, r, _, _ in daily_run.finished(spark, out_dir) if r.startswith(_prefix(stream))]
    return max((int(r.removeprefix(_prefix(stream))) for r in done), default=-1)


def _release(spark: SparkSession, out_dir: str, stream: str, last: int) -> None:
    """Remove the landed batches up to ``last``."""
    for kind in ("landed", "landed_ids", "landed_failed"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{kind}/stream={stream}")
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            continue
        left = 0
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("batch=") and int(name.removeprefix("batch=")) <= last:
                fs.delete(status.getPath(), True)
            else:
                left += 1
        if not left:
            fs.delete(folder, True)


def follow_pages(
    spark: SparkSession,
    source: str,
    out_dir: str,
    checkpoint: str,
    run_date: Callable[[], dt.date] = dt.date.today,
    labels: Labels = Labels(),
    max_files: int = 1000,
) -> DataFrame | None:
    """Take in every new parquet file of ``source``, then run the job once on what arrived.

    Micro-batches only read the pages and keep their elements under
    ``landed/stream=X/batch=N``; a batch that is replayed overwrites itself.
    The run covers all landed batches that no finished run of this stream has,
    so its result does not depend on how the files were cut into batches, and
    a card finds a page of another batch. A run that fails is made up for by the
    next call; what a run has taken in is released when it is done. Returns the
    report row, or None when there was nothing to store.
    """

    def land(pages: DataFrame, batch_id: int) -> None:
        if batch_id <= _last_done(spark, out_dir, stream_id(spark, checkpoint)):
            return  # replayed after its run had finished
        batch = f"stream={stream_id(spark, checkpoint)}/batch={batch_id:012d}"
        pages.select("page_id").write.mode("overwrite").parquet(f"{out_dir}/landed_ids/{batch}")
        explode_nodes(pages, items.REQUEST).write.mode("overwrite").parquet(f"{out_dir}/landed/{batch}")
        read = spark.read.schema(NODES).parquet(f"{out_dir}/landed/{batch}")
        if not read.where(F.col("error").isNotNull()).isEmpty():  # their bytes go to the quarantine with the run
            daily_run.failed_pages(pages, read).write.mode("overwrite").parquet(f"{out_dir}/landed_failed/{batch}")

    query = (
        spark.readStream.schema(PAGES)
        .option("maxFilesPerTrigger", max_files)
        .parquet(source)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

    stream = stream_id(spark, checkpoint)
    last_done = _last_done(spark, out_dir, stream)
    _release(spark, out_dir, stream, last_done)  # where a call ended between its run and this
    is_fresh = F.col("batch").cast("bigint") > last_done
    fresh = read_or_empty(spark, f"{out_dir}/landed/stream={stream}", f"{NODES}, batch string").where(is_fresh)
    ids = read_or_empty(spark, f"{out_dir}/landed_ids/stream={stream}", "page_id bigint, batch string").where(is_fresh)
    last = ids.agg(F.max(F.col("batch").cast("bigint"))).first()[0]
    if last is None:
        return None
    check_page_ids(ids)
    with Staging(spark) as staging:
        run_id = f"{_prefix(stream)}{last:012d}"
        columns = f"{daily_run.QUARANTINE.simpleString()[7:-1].replace(':', ' ')}, batch string"
        failed = read_or_empty(spark, f"{out_dir}/landed_failed/stream={stream}", columns).where(is_fresh).drop("batch")
        report = daily_run.run_nodes(
            fresh.drop("batch"), out_dir, run_date(), run_id, staging, labels=labels, strict=True, failed=failed
        )
    _release(spark, out_dir, stream, last)
    return report
