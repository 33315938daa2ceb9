"""Align, append and keep-first de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagestrata.functions.text import norm_text
from pagestrata.schema import COLUMNS, NORMALISED_KEYS, PRIMARY_KEYS


def align_columns(df: DataFrame, columns: list[str] = COLUMNS, fill: str = "", keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly ``columns`` in that order: absent ones filled, others dropped (but for ``keep``)."""
    have = set(df.columns)
    return df.select(
        *[F.col(f"`{c}`") if c in have else F.lit(fill).alias(c) for c in columns],
        *[F.col(c) for c in keep if c in have],
    )


def ensure_columns(df: DataFrame, columns: list[str], fill: str = "") -> DataFrame:
    """Add the absent ``columns`` and drop nothing."""
    missing = [c for c in columns if c not in df.columns]
    return df.select("*", *[F.lit(fill).alias(c) for c in missing])


def empty_as_null(df: DataFrame, columns: list[str] = COLUMNS) -> DataFrame:
    """Empty text becomes null, as after a trip through a sheet of cells."""
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in columns if c in df.columns})


def keep_first(df: DataFrame, keys: list[str], order: Column | str = "seq") -> DataFrame:
    """The first row of every key, by ``order``; null keys equal each other.

    ``row_number() = 1`` is pushed below the shuffle as a group limit, so each
    task sends at most one row per key however often the key occurs. The hash
    in front makes most comparisons of long keys a comparison of two numbers;
    the keys themselves still decide.
    """
    cols = [F.col(f"`{k}`") for k in keys]
    w = Window.partitionBy(F.xxhash64(*cols), *cols).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def digest(keys: list[str], empty_is_null: bool = False) -> Column:
    """32 bytes that tell any two different rows of key values apart; null is a value of its own."""
    parts = []
    for k in keys:
        text = F.col(f"`{k}`").cast("string")
        text = F.nullif(text, F.lit("")) if empty_is_null else text
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def append(base: DataFrame, batch: DataFrame) -> DataFrame:
    """Bag union with the base in front: ``seq.src`` is 0 for base rows and 1 for new ones."""
    return base.withColumn("seq", F.col("seq").withField("src", F.lit(0))).unionByName(
        batch.withColumn("seq", F.col("seq").withField("src", F.lit(1)))
    )


def consolidate(base: DataFrame, batch: DataFrame, keys: list[str] = PRIMARY_KEYS) -> DataFrame:
    """Base plus new rows, the first of each exact key kept."""
    return keep_first(append(base, batch), keys)


def normalise_keys(df: DataFrame, keys: list[str] = NORMALISED_KEYS) -> DataFrame:
    df = ensure_columns(df, keys)
    return df.withColumns({k: norm_text(F.col(f"`{k}`")) for k in keys})


def dedupe_normalised(df: DataFrame, keys: list[str] = NORMALISED_KEYS, order: Column | str = "seq") -> DataFrame:
    """First row of each normalised key. The normalised values are what is kept."""
    return keep_first(normalise_keys(df, keys), keys, order)


def count_removed(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row ``(before, kept, removed)`` for a keep-first on ``keys``.

    Long keys are counted through a digest of an unambiguous encoding, so only
    32 bytes per distinct key are shuffled.
    """
    return (
        df.groupBy(digest(keys).alias("k"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("before"),
            F.count(F.lit(1)).alias("kept"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
        )
    )
