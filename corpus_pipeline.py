"""From raw documents to shards: quality rules, near-duplicates, benchmark passages, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagestrata.llm import rule_list, token_mix
from pagestrata.llm.flow_shards import free_name, reshard, write_shards
from pagestrata.llm.positional_index import decontaminate
from pagestrata.llm.simhash_pivots import near_duplicates
from pagestrata.sources.tables import Staging

#: Name of the id that stages 2 and 3 go by: doc_id, or a hash of the text for a document without one, then a
#: hash of the text, as different texts may have one doc_id.
ID = "_pipeline_id"


def _with_id(docs: DataFrame) -> DataFrame:
    text = F.xxhash64("text")
    return docs.withColumn(ID, F.struct(F.coalesce("doc_id", text).alias("id"), text.alias("text")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and meet no learned rule."""
    rules = rule_list.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rule_list.judge(docs, rules).where("kept").select("row.*")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates, once."""
    docs = _with_id(docs)
    with Staging(spark) as work:
        found = near_duplicates(docs, work, id_col=ID)
        first = Staging(spark).store(found.where("id = component_id").select(F.col("id").alias(ID)).distinct(), "first")
    kept = docs.join(first, ID, "left_semi")
    once = F.row_number().over(Window.partitionBy(ID).orderBy(F.xxhash64("text")))
    return kept.withColumn("_once", once).where("_once = 1").drop("_once", ID)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any word in a window of a benchmark item."""
    docs = _with_id(docs).withColumn(ID, F.xxhash64(ID))
    with Staging(spark) as work:  # the index goes when the documents that match are known
        items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
        found = decontaminate(docs, items, work, id_col=ID, nameless=True)
        hit = Staging(spark).store(found.where("n_hit > 0").select(F.col("id").alias(ID)).distinct(), "hit")
    return docs.join(hit, ID, "left_anti").drop(ID)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as a mix of 150 % of all words takes them; sources weigh 3, 1, 2, repeating."""
    return token_mix.taken(token_mix.mix(docs, Staging(spark), weights=[3, 1, 2], share=1.5, most=2.0))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in eight shards of equal bytes, moved from five, read back from the written files."""
    with Staging(spark) as work:
        plan, placed = reshard(docs, work, old_shards=5, new_shards=8)
        written = write_shards(plan, placed, f"{Staging(spark).folder}/shards")
    own = [F.col(c).alias(free_name(c, docs.columns)) for c in ("size", "shard", "slot")]
    return written.select("row.*", *own)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicate_groups),
    ("benchmark passages", benchmark_passages),
    ("source mix", source_mix),
    ("shards", shards),
]

#: Learned rules and XXH64 fingerprints have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = staging.store(stage(spark, docs, sf_dir), f"stage_{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
