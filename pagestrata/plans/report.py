"""What a run tells its readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Name shown in the report; the sender signs with it.
SYSTEM = "PORTAL"


def _day(run_date: Column | str) -> Column:
    return F.date_format(F.col(run_date) if isinstance(run_date, str) else run_date, "yyyy-MM-dd")


# Wording of the report.
def subject(run_date: Column | str, removed: Column | str, system: str = SYSTEM) -> Column:
    return F.format_string(
        f"[{system}] Base extraída (%s) - Duplicados removidos: %d", _day(run_date), removed
    )


def body(
    run_date: Column | str, removed: Column | str, system: str = SYSTEM, enclosed: str = "Segue a planilha em anexo."
) -> Column:
    return F.format_string(
        "Olá,\n\n"
        "A base de atos foi gerada e deduplicada com sucesso em %s.\n"
        "Registros duplicados removidos (ignorando 'Data de extração'): %d.\n\n"
        f"{enclosed.replace('%', '%%')}\n\nAtt.,\nRobô {system}",
        _day(run_date),
        removed,
    )


def run_report(counts: DataFrame, system: str = SYSTEM, enclosed: str = "Segue a planilha em anexo.") -> DataFrame:
    """``counts(run_date, removed, ...)`` with ``subject`` and ``body`` added; ``enclosed`` says what comes with it."""
    return counts.withColumns(
        {"subject": subject("run_date", "removed", system), "body": body("run_date", "removed", system, enclosed)}
    )


def count_items(records: DataFrame) -> DataFrame:
    """Rows per run and source label."""
    return records.groupBy(F.col("seq.run_id").alias("run_id"), "Fonte").agg(
        F.count(F.lit(1)).alias("items")
    )
