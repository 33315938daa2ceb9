"""Mixing sources to target weights by thresholds on a hash of the document.

Word counts are summed by source and hash bucket. The running sum over the
buckets of a source shows in which bucket a budget ends; that bucket alone is
split into finer buckets, and again, down to single hashes. What is left is one
threshold for each source: a document is taken when its hash is below it.
Nothing is sorted and no text is moved. A larger budget has a larger threshold,
so the mix of a smaller budget is part of that of a larger one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagestrata.sources.tables import Staging

#: Words are runs of anything but ASCII whitespace.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a document's hash, and bits settled by each histogram.
BITS, STEP = 60, 12
#: Most sources that a mix can name; weights are a table made by people.
MAX_SOURCES = 100_000


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def doc_hash(id_col: str, text: str, seed: str = "mix") -> Column:
    """60 bits of an MD5 of the id, or of the text where there is no id; other engines have it too."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: list[float], share: float, most: float) -> list[float]:
    """Words for each source: ``share`` of all by weight, no source above ``most`` times its size.

    What a source cannot take goes to the others by weight, until all fit.
    """
    total = share * sum(n for _, n in sizes)
    open_, out = set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        weight = sum(weights[k] for k in open_)
        full = {k for k in open_ if weight <= 0 or total * weights[k] / weight > most * sizes[k][1]}
        for k in full or open_:
            out[k] = most * sizes[k][1] if k in full else total * weights[k] / weight
        if not full:
            break
        total -= sum(out[k] for k in full)
        open_ -= full
    return out


def thresholds(rows: DataFrame, budgets: DataFrame, staging: Staging) -> DataFrame:
    """``budgets(source, rest)`` with ``below``: documents whose hash is smaller make up about ``rest`` words.

    ``rows(source, hash, size)`` is read once for each histogram. Where a budget
    ends at a hash that several documents share, ``low`` is that hash and ``left``
    the words they are to add (else null): ``settle_ties`` says which of them do.
    """
    # base: words below the boundary bucket; low: its first hash; bits: settled so far.
    at = budgets.select("source", "rest", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("base"))
    levels = list(range(STEP, BITS + 1, STEP))
    for k, bits in enumerate(levels):
        wide, narrow = 1 << (BITS - bits + STEP), 1 << (BITS - bits)
        inside = rows.join(at.select(F.col("source").alias("s"), "low"), F.col("source").eqNullSafe(F.col("s")))
        inside = inside.where((F.col("hash") >= F.col("low")) & (F.col("hash") < F.col("low") + F.lit(wide)))
        bucket = (F.col("hash") - F.pmod("hash", F.lit(narrow))).alias("bucket")
        sums = inside.groupBy("source", bucket).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        sums = sums.join(at.select(F.col("source").alias("s"), "rest", "base"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        upto = Window.partitionBy("source").orderBy("bucket")  # at most 2 ** STEP rows for each source
        run = F.col("base") + F.sum("words").over(upto)
        sums = sums.select("source", "rest", "bucket", "words", "n", run.alias("run")).where(F.col("run") > F.col("rest"))
        first = sums.groupBy("source").agg(F.min(F.struct("bucket", "words", "run", "rest", "n")).alias("x"))
        at = first.select("source", "x.rest", F.col("x.bucket").alias("low"), (F.col("x.run") - F.col("x.words")).alias("base"), "x.words", "x.n")
        at = staging.store(at, f"boundary_{k}")
    # One hash is left: it goes in if that comes closer to the budget.
    left = F.col("rest") - F.col("base")
    nearer = F.when((F.col("n") == 1) & (2 * left > F.col("words")), 1).otherwise(0)
    end = at.select(F.col("source").alias("s"), (F.col("low") + nearer).alias("below"), F.when(F.col("n") > 1, F.col("low")).alias("low"), F.when(F.col("n") > 1, left).alias("left"))
    every = budgets.join(end, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return every.withColumn("below", F.coalesce("below", F.lit(1 << BITS)))


def mix(
    docs: DataFrame,
    staging: Staging,
    weights: dict[str | None, float] | list[float],
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``(row, size, source_size, target, copies)`` of every document; ``copies`` is how often the mix takes it.

    ``weights`` names sources (others weigh 0) or is a cycle over the sources in
    the order of their code points, null last. A document is taken whole: as
    often as its source's size fits into the target, and once more if its hash
    is below the source's threshold. A null text has size 0 and so has an empty
    one. Null is a source like others. Rows without id are hashed by their text.
    Rows that share an id share their fate, but where a budget ends among them:
    there as many of them are taken as come closest to it, so each source's words
    miss the target by half of one document at most.
    An empty table gives no rows. More than MAX_SOURCES sources are an error.
    """
    spark = docs.sparkSession
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(source).cast("string").alias("source"),
        doc_hash(id_col, text).alias("hash"),
        n_words(text).alias("size"),
    )
    slim = staging.store(packed.select("source", "hash", "size"), "sizes")
    found = slim.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = sorted(((r["source"], r["n"]) for r in found), key=lambda x: (x[0] is None, (x[0] or "").encode()))
    by_rank = isinstance(weights, list)
    of = [weights[k % len(weights)] if by_rank else weights.get(s, 0) for k, (s, _) in enumerate(sizes)]
    goal = targets(sizes, of, share, most)
    plan = [
        (s, n, t, int(t / n) if n else 0, float(t - n * int(t / n)) if n else 0.0) for (s, n), t in zip(sizes, goal)
    ]
    plan = spark.createDataFrame(plan, "source string, source_size long, target double, whole int, rest double")
    plan = plan.join(
        thresholds(slim, plan.select("source", "rest"), staging).select(F.col("source").alias("s"), "below", "low", "left"),
        F.col("source").eqNullSafe(F.col("s")),
    ).select(F.col("source").alias("of"), "source_size", "target", "whole", "below", "low", "left")
    # One row for each source, at most MAX_SOURCES.
    plan = staging.store(plan, "plan")
    tied = plan.where(F.col("low").isNotNull() & (F.col("whole") < most)).count() > 0
    plan = F.broadcast(plan)
    taken = F.col("whole") + F.when((F.col("whole") < most) & (F.col("hash") < F.col("below")), 1).otherwise(0)
    joined = packed.join(plan, F.col("source").eqNullSafe(F.col("of")))
    names = ["row", "size", "source_size", "target"]
    out = joined.select(*names, taken.cast("int").alias("copies"))
    if not tied:
        return out
    at_tie = F.coalesce((F.col("hash") == F.col("low")) & (F.col("whole") < most), F.lit(False))
    ties = settle_ties(joined.where(at_tie).select(*names, "of", "whole", "left"), staging).select(*names, "copies")
    return joined.where(~at_tie).select(*names, taken.cast("int").alias("copies")).unionByName(ties)


def settle_ties(rows: DataFrame, staging: Staging) -> DataFrame:
    """``rows`` with ``copies``: of each source's documents the first ones that add about ``left`` words.

    The rows are stored once, which fixes their order; each of its tasks sums its
    own part, however many rows share a hash.
    """
    numbered = rows.withColumn("part", F.spark_partition_id()).withColumn("n", F.monotonically_increasing_id())
    stored = staging.store(numbered, "ties")
    sums = stored.groupBy("of", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    sums = sums.select(F.col("of").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("of", "part").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    run = stored.select("of", "part", "n", "size").withColumn("run", F.sum("size").over(own))
    run = run.join(sums, F.col("of").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    run = run.select(F.col("n").alias("k"), (F.col("before") + F.col("run")).alias("run"))
    out = stored.join(run, F.col("n") == F.col("k"))
    more = F.when(2 * F.col("run") - F.col("size") < 2 * F.col("left"), 1).otherwise(0)
    return out.withColumn("copies", (F.col("whole") + more).cast("int"))


def taken(mixed: DataFrame) -> DataFrame:
    """The documents of a mix, each as often as it is taken."""
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")


def sql_targets(weights: list[float], share: float, most: float, rounds: int = 8) -> str:
    """DuckDB CTEs ``sizes`` and ``goal(source, n, target)``: the same shares, reshared ``rounds`` times."""
    cycle = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(weights))
    steps = reduce(
        lambda s, k: s
        + f""", goal_{k} AS (
        SELECT source, n, weight, CASE WHEN full_ THEN {most} * n ELSE
            ({share} * sum(n) OVER () - coalesce(sum({most} * n) FILTER (full_) OVER (), 0)) * weight
            / nullif(sum(weight) FILTER (NOT full_) OVER (), 0) END AS target,
            full_ OR CASE WHEN full_ THEN true ELSE
            ({share} * sum(n) OVER () - coalesce(sum({most} * n) FILTER (full_) OVER (), 0)) * weight
            / nullif(sum(weight) FILTER (NOT full_) OVER (), 0) > {most} * n END AS full_
        FROM {'ranked' if k == 0 else f'goal_{k - 1}'})""",
        range(rounds),
        "",
    )
    return f"""sizes AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
               ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15))::BIGINT AS hash
        FROM documents
    ), ranked AS (
        SELECT source, n, false AS full_,
            CASE ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % {len(weights)} {cycle} END AS weight
        FROM (SELECT source, sum(size)::DOUBLE AS n FROM sizes GROUP BY source)
    ){steps}, goal AS (SELECT source, n, target FROM goal_{rounds - 1})"""


SQL = f"""
    WITH {sql_targets([3, 1, 2], 1.5, 2.0)}, budget AS (
        SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS whole FROM goal
    ), running AS (
        SELECT s.*, n, target, whole, target - whole * n AS rest,
            sum(size) OVER (PARTITION BY s.source ORDER BY hash, size ROWS UNBOUNDED PRECEDING) AS run
        FROM sizes s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source
    )
    SELECT doc_id, size::BIGINT AS size, n::BIGINT AS source_size, target,
        (size * (whole + CASE WHEN whole < 2 AND 2 * run - size < 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM running
"""
