import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import TABLES, compare, connect

import __spark_entry__ as entry_points
import corpus_pipeline
from pagestrata.llm import positional_index, rule_list, simhash_pivots, token_mix
from pagestrata.llm.queries import ORACLE, QUERIES
from pagestrata.sources.tables import Staging

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    found = entry_points.queries()
    for n in range(1, 14):
        assert len([q for q in found if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in found and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, con, name):
    ours, theirs, differences = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert differences == [] and ours == theirs > 0


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for t in TABLES:
        pq.write_table(pq.read_schema(f"{SF}/{t}.parquet").empty_table(), folder / f"{t}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_empty_tables(spark, empty, name):
    rows = entry_points.queries()[name](spark, empty).collect()
    assert [r for r in rows if r.asDict().get("conv_id") != -1] == []


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """The small tables with nulls in every column, repeated rows and one more column."""
    folder = tmp_path_factory.mktemp("odd")
    for t in ("documents", "benchmark", "labels", "conversations"):
        rows = pq.read_table(f"{SF}/{t}.parquet")
        null = pa.table({c.name: pa.nulls(2, c.type) for c in rows.schema})
        some = pa.table({c.name: rows[c.name].slice(0, 3) if c.name != rows.schema[1].name else pa.nulls(3, c.type) for c in rows.schema})
        nameless = pa.table({c.name: rows[c.name].slice(0, 3) if k else pa.nulls(3, c.type) for k, c in enumerate(rows.schema)})
        rows = pa.concat_tables([rows, null, some, nameless, rows.slice(5, 2)])
        rows = rows.append_column("size", pa.array(range(len(rows)))).append_column("row", pa.array(["x"] * len(rows)))
        pq.write_table(rows, folder / f"{t}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_nulls_and_clashing_names(spark, odd, name):
    rows = entry_points.queries()[name](spark, odd).collect()
    if name not in ("op4_chat_parts", "op13_block_max", "pipeline"):
        assert len(rows) == spark.read.parquet(f"{odd}/documents.parquet").count()


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, every, text = docs.columns, ids(docs), {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "benchmark passages", "source mix", "shards"]

    with Staging(spark) as staging:
        good = staging.store(stages["quality rules"](spark, docs, SF), "good")
        rules = rule_list.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
        assert good.columns == columns and ids(good) == ids(rule_list.judge(docs, rules).where("kept").select("row.doc_id"))

        first = staging.store(stages["near-duplicates"](spark, good, SF), "first")
        prints = {k: simhash_pivots.fingerprint(text[k].encode()) for k in ids(good)}
        root = {k: k for k in prints}
        for _ in prints:
            moved = False
            for a in prints:
                for b in prints:
                    if root[b] < root[a] and (prints[a] ^ prints[b]).bit_count() <= 4:
                        root[a], moved = root[b], True
            if not moved:
                break
        assert first.columns == columns and ids(first) == sorted({*root.values()}) != ids(good)

        clean = staging.store(stages["benchmark passages"](spark, first, SF), "clean")
        items = [positional_index.alnum_words((r["text"] or "").encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
        windows = {tuple(w[k : k + 10]) for w in items if w for k in range(max(1, len(w) - 9))}
        lengths = {len(w) for w in windows}

        def dirty(t):
            w = positional_index.alnum_words(t.encode())
            return any(tuple(w[k : k + n]) in windows for n in lengths for k in range(len(w) - n + 1))

        assert clean.columns == columns and ids(clean) == [k for k in ids(first) if not dirty(text[k])] != ids(first)

        mixed = staging.store(stages["source mix"](spark, clean, SF), "mixed")
        plan = token_mix.mix(clean, staging_of(spark), weights=[3, 1, 2]).collect()
        assert mixed.columns == columns and ids(mixed) == sorted(r["row"]["doc_id"] for r in plan for _ in range(r["copies"]))

        out = stages["shards"](spark, mixed, SF).collect()
        assert sorted(r["doc_id"] for r in out) == ids(mixed) and all(r["text"] == text[r["doc_id"]] for r in out)
        for j in range(8):
            slots = sorted(r["slot"] for r in out if r["shard"] == j)
            assert slots == list(range(len(slots)))
        ran = [(r["doc_id"], r["shard"], r["slot"]) for r in corpus_pipeline.run(spark, SF).collect()]
        assert sorted(ran) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in out)
    assert every == sorted(text)


def staging_of(spark):
    return Staging(spark)


@pytest.fixture(scope="module")
def nameless(tmp_path_factory):
    """The small tables, where half of the benchmark's items have no id."""
    folder = tmp_path_factory.mktemp("nameless")
    for t in TABLES:
        rows = pq.read_table(f"{SF}/{t}.parquet")
        if t == "benchmark":
            ids = [None if k % 2 else i for k, i in enumerate(rows["item_id"].to_pylist())]
            rows = rows.set_column(rows.schema.get_field_index("item_id"), rows.schema.field("item_id"), [ids])
        pq.write_table(rows, folder / f"{t}.parquet")
    return str(folder)


def test_items_without_id_are_searched(spark, nameless):
    name = "op7_positional_index"
    ours, theirs, differences = compare(QUERIES[name](spark, nameless), connect(nameless), ORACLE[name])
    assert differences == [] and ours == theirs > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = dict(corpus_pipeline.STAGES)["benchmark passages"]
    assert ids(clean(spark, docs, nameless)) == ids(clean(spark, docs, SF)) != ids(docs)


def test_texts_that_share_an_id_are_kept_apart(spark):
    stages = dict(corpus_pipeline.STAGES)
    texts = {k: " ".join(f"{k}{n}" for n in range(60)) for k in "abcdefgh"}
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 60").first()["text"]
    said = {k: f"{t} {passage}" if k in "gh" else t for k, t in texts.items()}

    def kept(stage, rows):
        docs = spark.createDataFrame([(i, said[k], k) for i, k in rows], "doc_id long, text string, k string")
        return sorted((r["doc_id"], r["k"]) for r in stages[stage](spark, docs, SF).select("doc_id", "k").collect())

    # Every text also stands under 5, where another group has its first document or is the only one.
    rows = [(5, k) for k in "abcdef"] + [(5, "a"), (3, "b"), (3, "c"), (4, "d"), (9, "e")]
    assert kept("near-duplicates", rows) == [(3, "b"), (3, "c"), (4, "d"), (5, "a"), (5, "e"), (5, "f")]
    assert kept("benchmark passages", [(7, "a"), (7, "g"), (7, "b"), (8, "h"), (9, "c")]) == [(7, "a"), (7, "b"), (9, "c")]
