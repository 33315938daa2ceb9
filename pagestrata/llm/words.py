"""Words of UTF-8 texts and their hashes, and passes over the texts of a table in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes A-Z to a-z; all other bytes stay.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: The same, and every ASCII byte that is neither a digit nor a letter becomes a space.
ALNUM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
#: Seed of word hashes.
SEED = 42
#: Documents in one Arrow batch of the passes below; bounds memory, changes no result.
BATCH_CHARS = 4_000_000


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII characters."""
    return text.translate(ALNUM).split()


class WordHashes(dict):
    """Hash of each word met, kept up to a number of words."""

    def __init__(self, most: int = 200_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, SEED)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if it is shorter; none for none."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    out = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - size + 1 + k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def parts(batches: Iterable[pa.RecordBatch], column: Callable) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the text in each stays near BATCH_CHARS."""
    for batch in batches:
        size = max(1, column(batch).nbytes)
        rows = max(1, int(batch.num_rows * BATCH_CHARS / size))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_or_empty(text: str) -> F.Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def map_texts(df: DataFrame, text: str, make: Callable[[], Callable[[list[bytes]], list[pa.Array]]], fields: str) -> DataFrame:
    """``row`` (all columns of ``df`` in a struct) and ``out``, what ``make()`` finds in each text.

    ``make`` is called once in a task; what it returns takes UTF-8 texts (null:
    empty) and gives one Arrow array for each of ``fields``. All own names stay
    in ``out``, so columns of ``df`` cannot clash with them.
    """
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), text_or_empty(text).alias("text"))
    out = T.StructType.fromDDL(fields)
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), T.StructField("out", out)])

    def run(batches):
        of = make()
        for batch in parts(batches, lambda b: b.column(1)):
            found = pa.StructArray.from_arrays(of(utf8(batch.column(1))), names=out.names)
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["row", "out"])

    return packed.mapInArrow(run, schema)


def bounded_sample(df: DataFrame, key: str, most: int, seed: int = 7) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of ``key``: the same ones however the rows are dealt out."""
    hashed = df.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key)))
    share = most / max(1, df.count())
    if share < 1:  # a little less, so that the limit cuts the tail only
        hashed = hashed.where(F.col("_h") < F.lit(int(-(2**63) + share * 0.98 * 2**64)))
    return hashed.orderBy("_h").limit(most).drop("_h") if share < 1 else hashed.drop("_h")
