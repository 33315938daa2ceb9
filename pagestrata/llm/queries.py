"""One query for each operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.llm import block_max, chat_parts, merkle_midstates, rule_list, token_mix
from pagestrata.llm.bwt_merge import remove_repeats
from pagestrata.llm.co_training import co_train
from pagestrata.llm.flow_shards import reshard, write_shards
from pagestrata.llm.license_bands import scan_licenses
from pagestrata.llm.line_runs import deduplicate_lines
from pagestrata.llm.positional_index import decontaminate
from pagestrata.llm.secret_structure import BASE_KINDS, find_secrets, joined
from pagestrata.llm.simhash_pivots import near_duplicates
from pagestrata.sources.tables import Staging

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_co_training")
def op1_co_training(spark: SparkSession, sf: str) -> DataFrame:
    out, _ = co_train(table(spark, sf, "documents"), table(spark, sf, "labels"), Staging(spark))
    return out.withColumnRenamed("id", "doc_id")


@query(
    "op2_line_runs",
    r"""
    WITH lines AS (
        SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS k
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
    ), keyed AS (
        SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
    ), repeated AS (
        SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    ), marked AS (
        SELECT doc_id, k, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
        FROM keyed LEFT JOIN repeated USING (key)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op2_line_runs(spark: SparkSession, sf: str) -> DataFrame:
    out = deduplicate_lines(table(spark, sf, "documents"), Staging(spark))
    return out.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query("op3_flow_shards")
def op3_flow_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Five old shards to eight of equal bytes; the rows are read back from the written files."""
    staging = Staging(spark)
    plan, placed = reshard(table(spark, sf, "documents"), staging, old_shards=5, new_shards=8)
    written = write_shards(plan, placed, f"{staging.folder}/shards")
    return written.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.crc32(F.coalesce(F.col("row.text"), F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op4_chat_parts",
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
    ), ordered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
            len(regexp_extract_all(text, '<(\\*)(\||/?s>|unk>|pad>|</?SYS>>)|\[(\\*)(/?INST\])')) AS controls
        FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(17 + length(role) + length(text) + controls)::BIGINT AS formatted_chars
    FROM ordered GROUP BY conv_id
    """,
)
def op4_chat_parts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    turns = rows.unionByName(extra).withColumn("parts", chat_parts.text_parts("text"))
    return chat_parts.read_back(chat_parts.format_chats(turns)).withColumnRenamed("conv", "conv_id")


@query("op5_token_mix", token_mix.SQL)
def op5_token_mix(spark: SparkSession, sf: str) -> DataFrame:
    out = token_mix.mix(table(spark, sf, "documents"), Staging(spark), weights=[3, 1, 2], share=1.5, most=2.0)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return out.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", taken)


@query("op6_license_bands")
def op6_license_bands(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each document; ``licenses`` and ``spans`` (license:first word:end) of its matches in order."""
    out = scan_licenses(table(spark, sf, "documents"))
    found = F.col("out.matches")
    spans = F.transform(found, lambda m: F.concat_ws(":", m["license"], m["start"], m["stop"]))
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("out.n_words").alias("n_words"),
        F.size(found).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["license"]))), ",").alias("licenses"),
        F.array_join(spans, ",").alias("spans"),
        F.coalesce(F.array_max(F.transform(found, lambda m: m["containment"])), F.lit(0.0)).alias("containment"),
    )


@query(
    "op7_positional_index",
    r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ), items AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
    ), windows AS (
        SELECT DISTINCT item_id, least(10, len(w)) AS n, w[k : k + least(10, len(w)) - 1] AS words
        FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM items WHERE len(w) > 0)
    ), sizes AS (SELECT DISTINCT n FROM windows
    ), grams AS (
        SELECT doc_id, n, k, w[k : k + n - 1] AS words
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM words, sizes WHERE len(w) >= n)
    ), found AS (
        SELECT doc_id, g.k, g.n, item_id FROM grams g JOIN windows v ON g.n = v.n AND g.words = v.words
    ), places AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found)
        GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM words LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op7_positional_index(spark: SparkSession, sf: str) -> DataFrame:
    out = decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"), Staging(spark), nameless=True)
    items = F.array_sort(F.transform(F.array_distinct(F.transform("exact", lambda m: m["item_id"])), lambda i: i.cast("string")))
    out = out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", items.alias("items"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_secret_structure")
def op8_secret_structure(spark: SparkSession, sf: str) -> DataFrame:
    out = find_secrets(table(spark, sf, "documents"))
    base, added = F.col("out.base"), F.col("out.added")
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.concat(base, added)).alias("spans"),
        F.size(added).cast("long").alias("n_confirmed"),
    )


@query("op9_rule_list")
def op9_rule_list(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    out = rule_list.judge(docs, rule_list.fit(docs, table(spark, sf, "labels")))
    counts = [F.col(f"out.{c}").alias(c) for c in rule_list.COUNTS]
    return out.select(F.col("row.doc_id").alias("doc_id"), *counts, "base_failed", "kept", "rule")


@query("op10_simhash_pivots")
def op10_simhash_pivots(spark: SparkSession, sf: str) -> DataFrame:
    out = near_duplicates(table(spark, sf, "documents"), Staging(spark))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return out.select(F.col("id").alias("doc_id"), fingerprint, "component_id")


@query(
    "op11_bwt_merge",
    r"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
    ), windows AS (
        SELECT r, doc_id, k, substr(h, 2 * k + 1, 100) AS s
        FROM (SELECT *, unnest(range(0, greatest(0, len(h) // 2 - 49))) AS k FROM texts WHERE doc_id IS NOT NULL)
    ), firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s
    ), hits AS (
        SELECT r, k, coalesce(k - lag(k) OVER (PARTITION BY r ORDER BY k) > 50, true)::INT AS new
        FROM windows JOIN firsts USING (s) WHERE first < doc_id
    ), spans AS (
        SELECT r, min(k) AS a, max(k) + 50 AS b
        FROM (SELECT r, k, sum(new) OVER (PARTITION BY r ORDER BY k) AS span FROM hits) GROUP BY r, span
    ), pieces AS (
        SELECT r, a, b, substr(h, 2 * before + 1, 2 * (a - before)) AS piece
        FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans) JOIN texts USING (r)
    ), cut AS (
        SELECT r, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS tail, string_agg(piece, '' ORDER BY a) AS kept
        FROM pieces GROUP BY r
    )
    SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
        sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
    FROM texts LEFT JOIN cut USING (r)
    """,
)
def op11_bwt_merge(spark: SparkSession, sf: str) -> DataFrame:
    out = remove_repeats(table(spark, sf, "documents").select("doc_id", "text"), Staging(spark), digests=True)
    return out.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.lower(F.hex("kept")).alias("kept_sha256"),
    )


@query(
    "op12_merkle_midstates",
    r"""
    WITH RECURSIVE fields AS (
        SELECT row_number() OVER () AS rn, doc_id, source, text,
            coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id, '-')
            || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
            || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
            || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars, '-') AS head,
            replace(text, chr(10), '') AS cut,
            xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: xor(c // 2, (c % 2) * 3988292384)))) AS crc
        FROM documents
    ), leaves AS (
        SELECT rn, doc_id, source, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
            sha256(head || coalesce(CASE WHEN crc % 2 = 0 THEN strlen(cut)::VARCHAR || ':' || cut
                                    ELSE strlen(text)::VARCHAR || ':' || text END, '-')) AS other
        FROM fields
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves
    ), up AS (
        SELECT source, 0 AS lvl, list(leaf ORDER BY p) AS l FROM placed GROUP BY source
        UNION ALL
        SELECT source, lvl + 1, list_transform(range(0, len(l), 3), lambda i: sha256(array_to_string(l[i + 1 : i + 3], '')))
        FROM up WHERE len(l) > 1
    ), tops AS (
        SELECT source, l[1] AS top, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS p FROM up WHERE len(l) = 1
    ), high AS (
        SELECT 0 AS lvl, list(top ORDER BY p) AS l FROM tops
        UNION ALL
        SELECT lvl + 1, list_transform(range(0, len(l), 3), lambda i: sha256(array_to_string(l[i + 1 : i + 3], '')))
        FROM high WHERE len(l) > 1
    ), fold AS (
        SELECT rn, source, p, 0 AS lvl, other AS now, '' AS sibs FROM placed
        UNION ALL
        SELECT rn, f.source, p // 3, f.lvl + 1,
            sha256(array_to_string(list_transform(l[p - p % 3 + 1 : p - p % 3 + 3], lambda x, i: CASE WHEN i = p % 3 + 1 THEN now ELSE x END), '')),
            sibs || array_to_string(list_filter(l[p - p % 3 + 1 : p - p % 3 + 3], lambda x, i: i <> p % 3 + 1), '')
        FROM fold f JOIN up u ON f.source IS NOT DISTINCT FROM u.source AND f.lvl = u.lvl WHERE len(l) > 1
    ), met AS (
        SELECT rn, t.p, now, sibs, top FROM fold f
        JOIN up u ON f.source IS NOT DISTINCT FROM u.source AND f.lvl = u.lvl AND len(u.l) = 1
        JOIN tops t ON f.source IS NOT DISTINCT FROM t.source
    ), fold_high AS (
        SELECT rn, p, 0 AS lvl, now, sibs, top FROM met
        UNION ALL
        SELECT rn, p // 3, f.lvl + 1,
            sha256(array_to_string(list_transform(l[p - p % 3 + 1 : p - p % 3 + 3], lambda x, i: CASE WHEN i = p % 3 + 1 THEN now ELSE x END), '')),
            sibs || array_to_string(list_filter(l[p - p % 3 + 1 : p - p % 3 + 3], lambda x, i: i <> p % 3 + 1), ''), top
        FROM fold_high f JOIN high h ON f.lvl = h.lvl WHERE len(l) > 1
    )
    SELECT doc_id, leaf, top AS subroot, l[1] AS root, sha256(sibs) AS proof_sha256, now AS folded_root, now = l[1] AS verified
    FROM fold_high f JOIN high h ON f.lvl = h.lvl AND len(h.l) = 1 JOIN leaves USING (rn)
    """,
)
def op12_merkle_midstates(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose id has an even CRC-32 are held against their text without line ends."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle_midstates.audit(table(spark, sf, "documents"), Staging(spark), {"text": tampered})
    return out.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


@query(
    "op13_block_max",
    r"""
    WITH words AS (
        SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
    ), totals AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM words WHERE len(w) > 0
    ), items AS (
        SELECT q, item_id, unnest(list_distinct(w)) AS term FROM (
            SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark)
    ), tfs AS (
        SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM words)
        WHERE term IN (SELECT term FROM items) GROUP BY d, term
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
        FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals
    ), lengths AS (
        SELECT d, doc_id, 100 - 90 + (90 * len(w) * n_docs) // n_terms AS m FROM words, totals WHERE len(w) > 0
    ), scored AS (
        SELECT q, item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
        FROM items JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (d) GROUP BY q, item_id, d, doc_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
    )
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
)
def op13_block_max(spark: SparkSession, sf: str) -> DataFrame:
    out = block_max.rank(table(spark, sf, "documents"), table(spark, sf, "benchmark"), Staging(spark), most=10)
    return out.select(F.col("query_id").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
