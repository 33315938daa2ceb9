"""Table layouts and the fixed values of the record set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names and their order in the stored table.
COLUMNS = [
    "Ato",
    "Descrição",
    "Esfera",
    "UF",
    "Municipio",
    "Data de extração",
    "Data de publicação",
    "Fonte",
    "StatusCarga",
]

# Exact keys of the first de-duplication.
PRIMARY_KEYS = ["Ato", "Descrição", "Fonte"]

# Normalised keys of the second de-duplication.
NORMALISED_KEYS = [
    "Ato",
    "Descrição",
    "Esfera",
    "UF",
    "Municipio",
    "Data de publicação",
    "Fonte",
]

# Greetings that disqualify a description cell found by position only.
GREETINGS = ("Caro(a)", "Seguem abaixo as atualizações", "Título do alerta")


@dataclass(frozen=True)
class Labels:
    """Constants written into every record."""

    section_sphere: str = "MUNICIPAL"
    card_sphere: str = "FEDERAL"
    card_state: str = "FEDERAL"
    section_source: str = "PORTAL - MUNICIPAL"
    card_source: str = "PORTAL - FEDERAL"
    status: str = "novo"


#: Hidden order of a row: base rows first, then by run, page and place in the page.
SEQ = T.StructType(
    [
        T.StructField("src", T.IntegerType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("pre", T.LongType()),
    ]
)

RECORDS = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS] + [T.StructField("seq", SEQ)])

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)
