"""One run: captured pages in, new rows of the base and a report out.

Folders under ``out_dir``, one sub-folder per run, named by the run's number
and a random part:

* ``batch``         this run's records only
* ``consolidated``  those of them that pass the exact pass, as they were read (the backup)
* ``base``          those that pass the normalised pass too, normalised
* ``keys``          digests of the keys of the rows in ``base``, bucketed by digest
* ``newest``        the same for this run alone, not bucketed
* ``removed``       order values of older rows that the exact pass removes
* ``quarantine``    pages of this run that could not be read, as they came, with the error; see ``replay``
* ``linked``        title and body of the captured pages, by address, also of runs without items
* ``versions``      which folders make up the dataset; a run counts once its version, with its report, is written

The base is all ``base`` rows of a version without the ``removed`` ones. A run
holds its rows against bucketed digests, of which it shuffles nothing, and writes
new rows only. A run that died half-way is as if it had not happened and may be
started again. ``compact`` merges folders of one level into one of the next;
runs do so by themselves, so a version has few folders however many runs there
were. ``vacuum`` removes folders that only old versions list.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pagestrata.operators.dedupe import align_columns, digest, empty_as_null, normalise_keys
from pagestrata.operators.key_levels import KEYS, KeyLevels, merged, write_bucketed
from pagestrata.plans import items as items_plan
from pagestrata.plans.page_text import captured, unique_by_url
from pagestrata.plans.report import count_items, run_report
from pagestrata.schema import COLUMNS, NORMALISED_KEYS, PRIMARY_KEYS, RECORDS, SEQ, Labels
from pagestrata.sources.nodes import check_page_ids, explode_nodes, numbered
from pagestrata.sources.snapshots import Conflict, Part, Snapshots, Version
from pagestrata.sources.tables import Staging

log = logging.getLogger(__name__)

#: Folders of one level that are merged into one of the next.
FANOUT = 8
#: Largest part of a merged base or link folder, in rows a file.
ROWS_PER_FILE = 2_000_000

REPORT = T.StructType(
    [
        T.StructField("run_number", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("run_date", T.DateType()),
        T.StructField("items", T.LongType()),
        T.StructField("consolidated", T.LongType()),
        T.StructField("stored", T.LongType()),
        T.StructField("removed", T.LongType()),
        T.StructField("unreadable_pages", T.LongType()),
        T.StructField("items_by_source", T.MapType(T.StringType(), T.LongType())),
        T.StructField("subject", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)
NEWEST = T.StructType(
    [T.StructField(c, T.BinaryType()) for c in ("exact", "exact_null", "normal")] + [T.StructField("seq", SEQ)]
)
REMOVED = T.StructType([T.StructField("seq", SEQ)])
QUARANTINE = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.BinaryType())]
    + [T.StructField(c, T.StringType()) for c in ("charset", "error")]
)
LINKED = T.StructType([T.StructField(c, T.StringType()) for c in ("url", "title", "body", "run")])
VERSIONS = T.StructType([T.StructField("number", T.LongType()), T.StructField("report", REPORT)])
#: Kinds of folders that a version lists, and those that are kept for the user.
KINDS, BACKUPS = ["base", "keys", "newest", "removed", "linked", "quarantine"], ["batch", "consolidated"]


def reports(spark: SparkSession, out_dir: str) -> DataFrame:
    """All report rows so far."""
    snapshots = Snapshots(spark, out_dir)
    if not snapshots.numbers():
        return spark.createDataFrame([], REPORT)
    found = spark.read.schema(VERSIONS).json(snapshots.folder, pathGlobFilter="*.json").where(F.col("report").isNotNull())
    return found.select("report.*")


def finished(spark: SparkSession, out_dir: str) -> list[tuple[int, str, str, int]]:
    """``(number, run id, folder, rows of the base)`` of the finished runs, oldest first: a row for each run."""
    rows = reports(spark, out_dir).select("run_number", "run_id", "folder", "stored").collect()
    return sorted(tuple(r) for r in rows)


def last_run(spark: SparkSession, out_dir: str) -> str | None:
    """Id of the last finished run."""
    runs = finished(spark, out_dir)
    return runs[-1][1] if runs else None


def _parts(spark: SparkSession, out_dir: str, kind: str, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{out_dir}/{kind}/{f}" for f in folders])


def _of(spark: SparkSession, out_dir: str, version: Version, kind: str, schema: T.StructType) -> DataFrame:
    return _parts(spark, out_dir, kind, [p.folder for p in version.of(kind)], schema)


def current_base(spark: SparkSession, out_dir: str, empty_is_null: bool = False, version: int | None = None) -> DataFrame:
    """The base as the finished runs left it, or as an earlier version has it.

    The table keeps to its version, whatever is run, compacted or vacuumed within its time meanwhile.
    """
    snapshots = Snapshots(spark, out_dir)
    v = snapshots.latest() if version is None else snapshots.read(version)
    base = _of(spark, out_dir, v, "base", RECORDS)
    if v.of("removed"):
        base = base.join(_of(spark, out_dir, v, "removed", REMOVED), "seq", "left_anti")
    base = base.select(*COLUMNS, "seq")
    return empty_as_null(base) if empty_is_null else base


def exact_pass(batch: DataFrame, levels: KeyLevels, gone: DataFrame, empty_is_null: bool) -> DataFrame:
    """The first batch row of each exact key that the base, without the rows in ``gone``, does not have."""
    keyed = batch.withColumn("key", digest(PRIMARY_KEYS))
    known = levels.having(keyed, "exact_null" if empty_is_null else "exact").join(gone, "seq", "left_anti")
    return _first_new(keyed, known).drop("key")


def normalised_pass(rows: DataFrame, levels: KeyLevels, gone: DataFrame) -> DataFrame:
    """Of rows that passed: the first of each normalised key that the base does not have, normalised."""
    keyed = normalise_keys(rows).withColumn("key", digest(NORMALISED_KEYS))
    known = levels.having(keyed, "normal").join(gone, "seq", "left_anti")
    return _first_new(keyed, known).select(*COLUMNS, "seq")


def _first_new(keyed: DataFrame, known: DataFrame) -> DataFrame:
    """The first row of each ``key`` that is not among the known ones. A key is a digest, so one shuffle by it serves both."""
    first = Window.partitionBy("key").orderBy("seq")
    return keyed.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn").join(known, "key", "left_anti")


def overtaken(levels: KeyLevels, newest: DataFrame, empty_is_null: bool) -> DataFrame:
    """Keys and ``seq`` of the newest run's rows that, normalised, have the exact key of an earlier row.

    Rows of older runs were held against each other by the runs after them.
    """
    kind = "exact_null" if empty_is_null else "exact"
    asked = newest.withColumn("key", F.col(kind))
    first = levels.having(asked, kind).groupBy("key").agg(F.min("seq").alias("first"))
    return asked.join(first, "key").where(F.col("seq") > F.col("first")).drop("key", "first")


def _keys(rows: DataFrame, gone: bool) -> DataFrame:
    """``exact, exact_null, normal, seq`` as rows of KEYS."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in ("exact", "exact_null", "normal")])
    return rows.select(F.explode(kinds).alias("k"), "seq").select("k.kind", "k.key", "seq", F.lit(gone).alias("gone"))


def run(
    pages: DataFrame,
    out_dir: str,
    run_date: dt.date,
    run_id: str,
    linked: DataFrame | None = None,
    labels: Labels = Labels(),
    empty_is_null: bool = True,
    strict: bool = False,
) -> DataFrame | None:
    """Extract, consolidate, de-duplicate, report. Returns the report row, or None.

    Runs are numbered in the order in which they finish, and older rows win. A
    run id that is finished already is not run again. A card's link leads to
    the pages of this run, of ``linked`` and of all earlier runs, the newest
    capture first; stored records are not changed when a page comes later. None
    means that nothing was stored: no items, or storing failed; with ``strict``
    a failure is raised. Two pages with one id, and another run that finishes
    meanwhile, always raise.
    """
    spark = pages.sparkSession
    done = reports(spark, out_dir).where(F.col("run_id") == run_id)
    if not done.isEmpty():
        return done
    check_page_ids(pages)
    with Staging(spark) as staging:
        nodes = staging.store(explode_nodes(pages, items_plan.REQUEST), "nodes")
        failed = failed_pages(pages, nodes)
        return run_nodes(nodes, out_dir, run_date, run_id, staging, linked, labels, empty_is_null, strict, failed)


def failed_pages(pages: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pages with an error among ``nodes``, as they came: rows of QUARANTINE."""
    bad = nodes.where(F.col("error").isNotNull()).groupBy("page_id").agg(F.min("error").alias("error"))
    names = dict(pages.dtypes)
    charset = F.col("charset") if "charset" in names else F.lit("utf-8" if names["html"] == "string" else None)
    as_read = pages.select("page_id", "url", F.col("html").cast("binary").alias("html"), charset.cast("string").alias("charset"))
    return as_read.join(bad, "page_id").select(*QUARANTINE.names)


def quarantined(spark: SparkSession, out_dir: str) -> DataFrame:
    """Pages that could not be read and have not been taken in since."""
    return _of(spark, out_dir, Snapshots(spark, out_dir).latest(), "quarantine", QUARANTINE)


def replay(
    spark: SparkSession, out_dir: str, run_date: dt.date, run_id: str, labels: Labels = Labels(), empty_is_null: bool = True
) -> DataFrame | None:
    """Take in the quarantined pages as a run of their own, for example with a reader that was mended.

    Pages keep their order, by run and page id. What can be read leaves the
    quarantine, what fails again stays. Without quarantined pages nothing is run.
    """
    version = Snapshots(spark, out_dir).latest()
    waiting = version.of("quarantine")
    if not waiting or run_id in {r for _, r, _, _ in finished(spark, out_dir)}:
        return reports(spark, out_dir).where(F.col("run_id") == run_id) if waiting else None
    with Staging(spark) as staging:
        rows = [_parts(spark, out_dir, "quarantine", [p.folder], QUARANTINE).withColumn("of", F.lit(p.first)) for p in waiting]
        pages = reduce(DataFrame.unionByName, rows)
        # Runs number their pages independently; new numbers in the order of runs and pages.
        pages = pages.repartitionByRange("of", "page_id").sortWithinPartitions("of", "page_id")
        pages = staging.store(numbered(pages.drop("of", "error")), "pages")
        nodes = staging.store(explode_nodes(pages, items_plan.REQUEST), "nodes")
        return run_nodes(
            nodes, out_dir, run_date, run_id, staging, None, labels, empty_is_null, True, failed_pages(pages, nodes), waiting
        )


def run_nodes(
    nodes: DataFrame,
    out_dir: str,
    run_date: dt.date,
    run_id: str,
    staging: Staging,
    linked: DataFrame | None = None,
    labels: Labels = Labels(),
    empty_is_null: bool = True,
    strict: bool = False,
    failed: DataFrame | None = None,
    replayed: list[Part] | None = None,
) -> DataFrame | None:
    """``run`` on pages that are read already: a stored table of element rows.

    ``failed`` are the pages with an error, for the quarantine, ``replayed`` the
    folders of it that are taken in here. Elements of a page that failed half-way do not count.
    """
    spark = nodes.sparkSession
    snapshots = Snapshots(spark, out_dir)
    version = snapshots.latest()
    number = version.runs + 1
    buckets = version.settings.get("buckets") or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"run={number:012d}-{uuid.uuid4().hex[:8]}"

    bad = nodes.where(F.col("error").isNotNull()).select("page_id").distinct()
    unreadable = bad.count()
    if unreadable:
        log.warning("%d pages could not be read", unreadable)
        nodes = nodes.join(bad, "page_id", "left_anti")
    # Named by version, as runs that store nothing use no number up: later ones compare as larger.
    captured(nodes).withColumn("run", F.lit(f"{version.number + 1:012d}-{folder}")).write.mode("overwrite").parquet(f"{out_dir}/linked/{folder}")
    links = Part("linked", folder, 0, number, number)
    taken = [links]
    if unreadable and failed is not None:
        failed.write.mode("overwrite").parquet(f"{out_dir}/quarantine/{folder}")
        taken.append(Part("quarantine", folder, 0, number, number))

    def known(asked: DataFrame) -> DataFrame:
        return _known_pages(spark, out_dir, replace(version, parts=(*version.parts, links)), asked, linked)

    def nothing_stored() -> None:
        _commit(snapshots, version, taken, None, {"buckets": buckets}, replayed)

    records = items_plan.extract_items(nodes, run_date, f"{number:012d}", staging.store, known, labels)
    records = align_columns(records, COLUMNS, keep=("seq",))
    try:
        records.write.mode("overwrite").parquet(f"{out_dir}/batch/{folder}")
        batch = _parts(spark, out_dir, "batch", [folder], RECORDS)
    except Exception:
        log.exception("batch snapshot not written; going on")
        batch = staging.store(records, "items")
    by_source = {r["Fonte"]: r["items"] for r in count_items(batch).collect()}  # one row for each kind of source
    n_items = sum(by_source.values())
    if n_items == 0:
        log.info("no items, nothing to store")
        snapshots.remove("batch", folder)
        nothing_stored()
        return None

    with KeyLevels(spark, snapshots.paths(version.of("keys")), buckets) as levels:
        try:
            newest = _of(spark, out_dir, version, "newest", NEWEST)
            gone = staging.store(overtaken(levels, newest, empty_is_null), "gone")
            exact_pass(batch, levels, gone, empty_is_null).write.mode("overwrite").parquet(f"{out_dir}/consolidated/{folder}")
        except Exception:
            log.exception("consolidation failed; the base stays as it was")
            if strict:
                raise
            nothing_stored()
            return None

        try:
            passed = _parts(spark, out_dir, "consolidated", [folder], RECORDS)
            normalised_pass(passed, levels, gone).write.mode("overwrite").parquet(f"{out_dir}/base/{folder}")
            fresh = _parts(spark, out_dir, "base", [folder], RECORDS)
            fresh.select(
                digest(PRIMARY_KEYS).alias("exact"),
                digest(PRIMARY_KEYS, empty_is_null=True).alias("exact_null"),
                digest(NORMALISED_KEYS).alias("normal"),
                "seq",
            ).write.mode("overwrite").parquet(f"{out_dir}/newest/{folder}")
            mine = _parts(spark, out_dir, "newest", [folder], NEWEST)
            write_bucketed(_keys(mine, False).unionByName(_keys(gone, True)), f"{out_dir}/keys/{folder}", "key", buckets)
            parts = taken + [Part(k, folder, 0, number, number) for k in ("base", "keys", "newest")]
            n_gone = gone.count()
            if n_gone:
                gone.select("seq").write.mode("overwrite").parquet(f"{out_dir}/removed/{folder}")
                parts.append(Part("removed", folder, 0, number, number))
            older = version.settings.get("stored", 0) - n_gone
            n_passed, n_fresh = passed.count(), fresh.count()
            counts = spark.createDataFrame(
                [(number, run_id, folder, run_date, n_items, older + n_passed, older + n_fresh, n_passed - n_fresh, unreadable, by_source)],
                T.StructType(REPORT.fields[:-2]),
            )
            report = run_report(counts).first().asDict()
            _commit(snapshots, version, parts, report, {"buckets": buckets, "stored": older + n_fresh}, replayed)
        except Exception as e:
            log.exception("post-processing failed; the base stays as it was")
            if strict or isinstance(e, Conflict):
                raise
            nothing_stored()
            return None
    compact(spark, out_dir)
    return reports(spark, out_dir).where(F.col("run_id") == run_id)


def _commit(
    snapshots: Snapshots, seen: Version, parts: list[Part], report: dict | None, settings: dict, without: list[Part] | None = None
) -> None:
    """A new version with ``parts`` and without some others. Merges and links that came since ``seen`` are no obstacle to it, runs are to a run."""
    if report is not None:
        report = report | {"run_date": report["run_date"].isoformat()}
    while True:
        now = snapshots.latest()
        if report is not None and now.runs != seen.runs:
            raise Conflict(f"another run finished while {report['run_id']!r} was at work; start it again")
        others = [p for p in now.parts if p not in (without or []) and (report is None or p.kind != "newest")]  # one newest run
        try:
            snapshots.commit(now, [*others, *parts], now.runs + (report is not None), report, now.settings | settings if report else settings | now.settings)
            return
        except Conflict:
            log.info("another version was written meanwhile; looking again")


def _large_files(rows: DataFrame, order: str, target: str) -> None:
    """Write rows in ranges of ``order``, in files of up to ROWS_PER_FILE rows."""
    rows.repartitionByRange(order).sortWithinPartitions(order).write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(target)


def _merge(spark: SparkSession, snapshots: Snapshots, version: Version, kind: str, some: list[Part], target: str) -> None:
    """One folder in place of some of one kind."""
    if kind == "keys":
        write_bucketed(merged(spark, snapshots.paths(some)), target, "key", version.settings["buckets"])
        return
    schema = {"base": RECORDS, "linked": LINKED, "removed": REMOVED}[kind]
    rows = spark.read.schema(schema).parquet(*snapshots.paths(some))
    if kind == "base" and version.of("removed"):
        rows = rows.join(_of(spark, snapshots.out_dir, version, "removed", REMOVED), "seq", "left_anti")
    if kind == "linked":  # the newest capture of an address is what is read
        rows = rows.groupBy("url").agg(F.max_by(F.struct("title", "body"), "run").alias("shown"), F.max("run").alias("run"))
        rows = rows.select("url", "shown.title", "shown.body", "run")
    _large_files(rows.select(*schema.names), "url" if kind == "linked" else "seq", target)


def compact(spark: SparkSession, out_dir: str, fanout: int | None = None) -> Version:
    """Merge folders: ``fanout`` of one level become one of the next; removed rows go from the base where it is merged.

    Readers of older versions are not disturbed, as nothing is changed or
    deleted. A run that finishes meanwhile is no obstacle: it adds folders, and the
    merged ones replace those they were made of.
    """
    fanout = fanout or FANOUT
    snapshots = Snapshots(spark, out_dir)
    while True:
        version = snapshots.latest()
        due = None
        for kind in ("base", "keys", "linked", "removed"):
            for level in sorted({p.level for p in version.of(kind)}):
                some = [p for p in version.of(kind) if p.level == level]
                if len(some) >= fanout:
                    due = due or (kind, level, some)
        if due is None:
            return version
        kind, level, some = due
        part = Part(kind, f"merged={uuid.uuid4().hex}", level + 1, min(p.first for p in some), max(p.last for p in some))
        _merge(spark, snapshots, version, kind, some, snapshots.path(part))
        _replace(snapshots, version, some, part)


def _replace(snapshots: Snapshots, seen: Version, some: list[Part], part: Part) -> None:
    """A new version in which ``part``, made from ``seen``, stands for ``some``; if those are gone, another merge was faster."""
    while True:
        now = snapshots.latest()
        if not set(some) <= set(now.parts):
            return
        rest = [p for p in now.parts if p not in some]
        if part.kind == "base":
            # A run removes rows of the run before it: its marks are spent once those rows are merged without them.
            spent = [p for p in seen.of("removed") if part.first <= p.first - 1 and p.last - 1 <= part.last]
            rest = [p for p in rest if p not in spent]
        try:
            snapshots.commit(now, [*rest, part], now.runs, None)
            return
        except Conflict:
            log.info("another version was written meanwhile; looking again")


def vacuum(spark: SparkSession, out_dir: str, keep: dt.timedelta = dt.timedelta(days=7), backups: bool = False) -> list[str]:
    """Remove the folders that only versions older than ``keep`` list, and what runs that died have left.

    Readers have so long to finish. With ``backups``, the batches and backups of runs older than that go too.
    """
    return Snapshots(spark, out_dir).vacuum([*KINDS, *(BACKUPS if backups else [])], keep)


def _known_pages(spark: SparkSession, out_dir: str, version: Version, links: DataFrame, given: DataFrame | None) -> DataFrame:
    """Pages behind ``links(url)``, one row for each: from the newest run that captured it, else as given.

    Captured pages are known whether or not their run stored anything. Only the
    few addresses asked for are taken from the store.
    """
    stored = _of(spark, out_dir, version, "linked", LINKED).select("url", F.struct("title", "body").alias("shown"), "run")
    if given is not None:
        given = unique_by_url(given.withColumn("page_id", F.lit(0)) if "page_id" not in given.columns else given)
        stored = stored.unionByName(given.select("url", F.struct("title", "body").alias("shown"), F.lit("").alias("run")))
    asked = stored.join(links, "url", "left_semi")
    return asked.groupBy("url").agg(F.max_by("shown", "run").alias("shown")).select("url", "shown.title", "shown.body")


def export_csv(spark: SparkSession, out_dir: str, target: str) -> None:
    """The current base without its hidden order column, as CSV files with a header."""
    current_base(spark, out_dir).select(*COLUMNS).write.mode("errorifexists").csv(
        target, header=True, quoteAll=True, escape='"'
    )
