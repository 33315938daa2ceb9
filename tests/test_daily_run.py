import datetime as dt
import os
import random
from functools import partial

import pytest

from pagestrata.operators import key_levels
from pagestrata.operators.key_levels import KeyLevels
from pagestrata.plans import daily_run
from pagestrata.schema import COLUMNS, PAGES
from pagestrata.sources import nodes
from pagestrata.sources.page_tree import page_elements
from pagestrata.sources.snapshots import Conflict, Part, Snapshots, Version
from pagestrata.streaming.arrivals import follow_pages

DAY1, DAY2 = dt.date(2025, 11, 5), dt.date(2025, 11, 6)


def page(*acts, city="Um"):
    rows = "".join(f"<tr><td class=txt_cinza><strong>{t}</strong><br>{d}</td></tr>" for t, d in acts)
    return f"<table><tr><td><strong>ISSQN - SP - {city}</strong></td></tr>{rows}</table>"


def stored(spark, out):
    rows = daily_run.current_base(spark, out).orderBy("seq").collect()
    return [(r["Ato"], r["Descrição"], r["Municipio"], r["Data de extração"]) for r in rows]


def test_two_days(spark, pages_of, tmp_path):
    out = str(tmp_path / "out")
    first = daily_run.run(
        pages_of(page(("Lei 1 01/02/2025", "simples"), ("Lei 2 01/02/2025", "linha 1<br>linha 2"), ("Lei 3 01/02/2025", ""))),
        out, DAY1, "0001",
    ).first()
    assert (first["items"], first.consolidated, first.stored, first.removed) == (3, 3, 3, 0)
    day1 = [
        ("Lei 1 01/02/2025", "simples", "Um", "2025-05-11"),
        ("Lei 2 01/02/2025", "linha 1 linha 2", "Um", "2025-05-11"),
        ("Lei 3 01/02/2025", "", "Um", "2025-05-11"),
    ]
    assert stored(spark, out) == day1

    second = daily_run.run(
        pages_of(
            page(
                ("Lei 1 01/02/2025", "simples"),  # exact copy: dropped by the exact pass
                ("Lei 2 01/02/2025", "linha 1<br>linha 2"),  # several lines: dropped by the second pass
                ("Lei 3 01/02/2025", ""),  # empty against missing: dropped by the second pass
                ("Lei 4 01/02/2025", "nova"),
                ("Lei  4 01/02/2025", "nova"),  # spaces collapse on the page already: exact copy
            ),
            page(("Lei 1 01/02/2025", "simples"), city="Dois"),  # the place is no exact key
        ),
        out, DAY2, "0002",
    ).first()
    assert (second["items"], second.consolidated, second.stored, second.removed) == (6, 6, 4, 2)
    assert second.run_date == DAY2 and "removidos: 2" in second.subject
    assert stored(spark, out) == [*day1, ("Lei 4 01/02/2025", "nova", "Um", "2025-06-11")]

    # a finished run is not repeated, and runs are numbered as they finish, whatever their ids
    assert daily_run.run(pages_of(page(("Lei 9", "x"))), out, DAY2, "0002").first().stored == 4

    # nothing found, nothing stored
    assert daily_run.run(pages_of("<p>vazio"), out, DAY2, "0003") is None
    assert daily_run.last_run(spark, out) == "0002" and len(list((tmp_path / "out/batch").iterdir())) == 2

    daily_run.export_csv(spark, out, str(tmp_path / "csv"))
    exported = spark.read.csv(str(tmp_path / "csv"), header=True, escape='"', multiLine=True)
    assert exported.columns == COLUMNS and exported.count() == 4


def test_failures_are_staged(spark, pages_of, tmp_path, monkeypatch):
    out = tmp_path / "out"
    out.mkdir()
    (out / "batch").write_text("a file where the folder should be")
    run = partial(daily_run.run, out_dir=str(out), run_date=DAY1)
    # The batch snapshot may fail; the run goes on.
    assert run(pages_of(page(("Lei 1", "x"))), run_id="1").first().stored == 1

    def fail(*args, **kwargs):
        raise RuntimeError("disk full")

    for step in ("overtaken", "exact_pass", "normalised_pass", "run_report"):
        with monkeypatch.context() as m:
            m.setattr(daily_run, step, fail)
            assert run(pages_of(page(("Lei 2", "y"))), run_id="2") is None
            with pytest.raises(RuntimeError):
                run(pages_of(page(("Lei 2", "y"))), run_id="2", strict=True)
        assert daily_run.last_run(spark, str(out)) == "1"
        assert [r[0] for r in stored(spark, str(out))] == ["Lei 1"]
    # Starting the failed run again completes it.
    assert run(pages_of(page(("Lei 2", "y"))), run_id="2").first().stored == 2


def test_an_older_row_goes_when_it_is_overtaken(spark, pages_of, tmp_path):
    """Several lines in two cities: only once normalised do they have one exact key, so the next run removes one."""
    out = str(tmp_path / "out")
    run = partial(daily_run.run, out_dir=out, run_date=DAY1, strict=True)
    act = ("Lei 1", "a<br>b")
    first = run(pages_of(page(act), page(("Lei 1", "a b"), city="Dois")), run_id="a").first()
    assert (first.consolidated, first.stored, first.removed) == (2, 2, 0)
    second = run(pages_of(page(("Lei 2", "c"))), run_id="b").first()
    assert (second.consolidated, second.stored, second.removed) == (2, 2, 0)
    assert [r[:3] for r in stored(spark, out)] == [("Lei 1", "a b", "Um"), ("Lei 2", "c", "Um")]
    # The removed row no longer stands in the way of its like.
    third = run(pages_of(page(act, city="Dois")), run_id="c").first()
    assert (third.consolidated, third.stored, third.removed) == (3, 3, 0)
    fourth = run(pages_of(page(("Lei 3", "d"))), run_id="d").first()
    assert (fourth.consolidated, fourth.stored) == (3, 3)


def reference(days):
    """Both passes over whole bases, as the rules say: rows are (title, description, city)."""
    base, counts = [], []
    for rows in days:
        seen, kept = set(), []
        for r in base + rows:
            if (r[0], r[1] or None) not in seen:
                seen.add((r[0], r[1] or None))
                kept.append(r)
        normal, base = set(), []
        for a, d, c in kept:
            r = (" ".join(a.split()), " ".join(d.split()), c)
            if r not in normal:
                normal.add(r)
                base.append(r)
        counts.append((len(kept), len(base), len(kept) - len(base)))
    return base, counts


def test_many_days_equal_whole_passes(spark, pages_of, tmp_path):
    rng = random.Random(2)
    days = [
        [(f"Lei {rng.randint(1, 4)}", rng.choice(["a b", "a\nb", "c", "c\nd", "c d"]), rng.choice(["Um", "Dois"])) for _ in range(9)]
        for _ in range(4)
    ]
    counts = []
    for n, rows in enumerate(days):
        pages = [page((t, d.replace("\n", "<br>")), city=c) for t, d, c in rows]
        r = daily_run.run(pages_of(*pages), str(tmp_path), DAY1, f"run {9 - n}", strict=True).first()
        counts.append((r.consolidated, r.stored, r.removed))
    base, expected = reference(days)
    assert counts == expected and [r[:3] for r in stored(spark, str(tmp_path))] == base


def test_a_run_does_not_read_the_texts_of_the_base(spark, pages_of, tmp_path, monkeypatch):
    out = str(tmp_path)
    daily_run.run(pages_of(page(("Lei 1", "a"))), out, DAY1, "1", strict=True)
    read = []
    parts = daily_run._parts
    monkeypatch.setattr(daily_run, "_parts", lambda s, o, kind, folders, schema: read.append((kind, tuple(folders))) or parts(s, o, kind, folders, schema))
    daily_run.run(pages_of(page(("Lei 2", "b"))), out, DAY2, "2", strict=True)
    old = daily_run.finished(spark, out)[0][2]
    assert {k for k, f in read if old in f} == {"newest", "linked"}


def scans_below(plan, joined=False):
    """Scans under an Exchange of a plan that no join separates from it."""
    name = plan.nodeName()
    if "Scan" in name and plan.children().isEmpty():
        yield plan.verboseStringWithSuffix(1000) if joined else ""
    inner = [plan.children().apply(k) for k in range(plan.children().size())]
    if name == "AdaptiveSparkPlan":
        inner = [plan.initialPlan()]
    under = True if name.startswith("Exchange") else False if "Join" in name else joined
    for child in inner:
        yield from scans_below(child, under)


def test_nothing_of_the_digests_is_shuffled(spark, pages_of, tmp_path):
    out = str(tmp_path)
    for n in range(3):
        daily_run.run(pages_of(page((f"Lei {n}", "a"), ("Lei 9", f"b{n}"))), out, DAY1, f"{n}", strict=True)
    snapshots = Snapshots(spark, out)
    version = snapshots.latest()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with KeyLevels(spark, snapshots.paths(version.of("keys")), version.settings["buckets"]) as levels:
            assert len(levels.names) == 3
            batch = daily_run.current_base(spark, out)
            gone = spark.createDataFrame([], daily_run.REMOVED)
            newest = daily_run._of(spark, out, version, "newest", daily_run.NEWEST)
            plans = [
                daily_run.exact_pass(batch, levels, gone, True),
                daily_run.normalised_pass(batch, levels, gone),
                daily_run.overtaken(levels, newest, True),
            ]
            for p in plans:
                found = list(scans_below(p._jdf.queryExecution().executedPlan()))
                assert any(found) and not any("keys" in f and "levels_" in f for f in found)
            assert plans[0].count() == 0 and plans[1].count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("levels_")]


def test_many_runs_stay_few_folders(spark, pages_of, tmp_path, monkeypatch):
    """Merges change no row; a reader that is open keeps its version; vacuum takes what only old versions list."""
    monkeypatch.setattr(daily_run, "FANOUT", 3)
    rng, days, out = random.Random(5), [], str(tmp_path)
    reader = before = None
    for n in range(13):
        days.append([(f"Lei {rng.randint(1, 5)}", rng.choice(["a b", "a\nb", "c", "c d"]), rng.choice(["Um", "Dois"])) for _ in range(4)])
        pages = [page((t, d.replace("\n", "<br>")), city=c) for t, d, c in days[-1]]
        r = daily_run.run(pages_of(*pages), out, DAY1, f"run {n}", strict=True).first()
        if n == 7:
            reader, before = daily_run.current_base(spark, out), [r["Ato"] for r in daily_run.current_base(spark, out).orderBy("seq").collect()]
    base, counts = reference(days)
    assert (r.consolidated, r.stored, r.removed) == counts[-1] and [r[:3] for r in stored(spark, out)] == base
    version = Snapshots(spark, out).latest()
    assert version.runs == 13 and len(daily_run.finished(spark, out)) == 13
    for kind in ("base", "keys", "linked"):
        assert len(version.of(kind)) <= 6 < len(os.listdir(tmp_path / kind))
    assert len(version.of("newest")) == 1
    assert [r["Ato"] for r in reader.orderBy("seq").collect()] == before  # one state, though its folders were merged
    assert daily_run.vacuum(spark, out, dt.timedelta(days=1)) == []
    assert len(daily_run.vacuum(spark, out, dt.timedelta(0))) > 5
    assert {k: len(os.listdir(tmp_path / k)) for k in ("base", "keys", "newest")} == {k: len(version.of(k)) for k in ("base", "keys", "newest")}
    assert [r[:3] for r in stored(spark, out)] == base


def test_a_merge_and_a_run_at_a_time(spark, pages_of, tmp_path, monkeypatch):
    """A run that finishes while folders are merged loses nothing, and neither do the marks it sets."""
    out, act = str(tmp_path), ("Lei 1", "a<br>b")
    run = partial(daily_run.run, out_dir=out, run_date=DAY1, strict=True)
    run(pages_of(page(("Lei 0", "z"))), run_id="1")
    run(pages_of(page(act), page(("Lei 1", "a b"), city="Dois")), run_id="2")
    inner = daily_run._merge

    def meanwhile(*args):
        inner(*args)
        monkeypatch.setattr(daily_run, "_merge", inner)
        monkeypatch.setattr(daily_run, "compact", lambda *a: None)
        run(pages_of(page(("Lei 2", "c"))), run_id="3")  # marks a row of run 2, which is being merged
        monkeypatch.undo()

    monkeypatch.setattr(daily_run, "_merge", meanwhile)
    daily_run.compact(spark, out, fanout=2)
    assert [r[:3] for r in stored(spark, out)] == [("Lei 0", "z", "Um"), ("Lei 1", "a b", "Um"), ("Lei 2", "c", "Um")]
    version = Snapshots(spark, out).latest()
    assert version.runs == 3 and len(version.of("removed")) == 1
    daily_run.compact(spark, out, fanout=2)
    assert [r[0] for r in stored(spark, out)] == ["Lei 0", "Lei 1", "Lei 2"]


def test_two_writers_of_one_version(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    first = snapshots.commit(snapshots.latest(), [Part("base", "a")], 1)
    with pytest.raises(Conflict):
        snapshots.commit(Version(), [Part("base", "b")], 1)
    assert snapshots.latest() == first and snapshots.numbers() == [1] and len(os.listdir(tmp_path / "versions")) <= 2


def test_report_counts_sources_and_bad_pages(spark, pages_of, tmp_path, monkeypatch):
    def broken(html, url, request):
        if "quebrada" in html:
            raise RuntimeError("no")
        return page_elements(html, url, request)

    monkeypatch.setattr(nodes, "page_elements", broken)
    pages = pages_of(page(("Lei 1", "a"), ("Lei 2", "b")), "<ul><li><a href=/x>um</a></ul>", "<p>quebrada")
    r = daily_run.run(pages, str(tmp_path), DAY1, "1", strict=True).first()
    assert r.unreadable_pages == 1 and r.items_by_source == {"PORTAL - MUNICIPAL": 2, "PORTAL - FEDERAL": 1}


def test_repeated_page_ids_end_the_run(spark, pages_of, tmp_path):
    pages = pages_of(page(("Lei 1", "a"))).unionByName(pages_of(page(("Lei 2", "b"), city="Dois")))
    with pytest.raises(ValueError, match="page id 0"):
        daily_run.run(pages, str(tmp_path), DAY1, "1")
    assert daily_run.last_run(spark, str(tmp_path)) is None


def test_a_run_that_would_hide_another_fails(spark, pages_of, tmp_path, monkeypatch):
    out, inner = str(tmp_path), daily_run.run_report

    def meanwhile(counts):
        monkeypatch.setattr(daily_run, "run_report", inner)
        daily_run.run(pages_of(page(("Lei 1", "a"))), out, DAY1, "other", strict=True)
        return inner(counts)

    monkeypatch.setattr(daily_run, "run_report", meanwhile)
    with pytest.raises(RuntimeError, match="another run finished"):
        daily_run.run(pages_of(page(("Lei 2", "b"))), out, DAY1, "this")
    assert [r[0] for r in stored(spark, out)] == ["Lei 1"]
    daily_run.run(pages_of(page(("Lei 2", "b"))), out, DAY1, "this", strict=True)
    assert [r[0] for r in stored(spark, out)] == ["Lei 1", "Lei 2"]


def test_links_to_pages_of_other_days(spark, pages_of, tmp_path):
    out = str(tmp_path)
    article = "<article><h1>Título</h1><p>corpo</p></article>"
    assert daily_run.run(pages_of(article, url="http://h.example/d/{}"), out, DAY1, "1") is None
    card = "<ul><li><a href='http://h.example/d/0#x'>curto</a><p>resumo</p></li></ul>"
    daily_run.run(pages_of(card), out, DAY2, "2", strict=True)
    assert [r[:2] for r in stored(spark, out)] == [("Título", "corpo")]


def test_staged_tables_go(spark, pages_of, tmp_path, monkeypatch):
    folders = []
    init = daily_run.Staging.__init__
    monkeypatch.setattr(daily_run.Staging, "__init__", lambda self, s: init(self, s) or folders.append(self.folder))
    daily_run.run(pages_of(page(("Lei 1", "a"))), str(tmp_path), DAY1, "1", strict=True)
    assert folders and not any(os.path.exists(f.removeprefix("file:")) for f in folders)


@pytest.fixture
def follow(spark, tmp_path):
    def run(checkpoint="cp", out="out", max_files=1000):
        where = [str(tmp_path / d) for d in ("pages", out, checkpoint)]
        return follow_pages(spark, *where, run_date=lambda: DAY1, max_files=max_files)

    return run


def test_stream_of_arrivals(spark, pages_of, tmp_path, follow):
    source, out = (str(tmp_path / d) for d in ("pages", "out"))
    pages_of(page(("Lei 1", "a"))).write.parquet(source)
    assert follow().first().stored == 1
    assert [r[0] for r in stored(spark, out)] == ["Lei 1"]
    pages_of(page(("Lei 1", "a"), ("Lei 2", "b"))).write.mode("append").parquet(source)
    follow()
    assert not list(tmp_path.glob("out/landed*/stream=*"))  # what is taken in is released
    assert follow() is None
    assert [r[0] for r in stored(spark, out)] == ["Lei 1", "Lei 2"]
    assert daily_run.reports(spark, out).count() == 2
    assert [f.name for f in PAGES] == ["page_id", "url", "html"]


def test_a_new_checkpoint_loses_nothing(spark, pages_of, tmp_path, follow):
    source, out = (str(tmp_path / d) for d in ("pages", "out"))
    daily_run.run(pages_of(page(("Lei 0", "z"))), out, DAY1, "20251105")
    pages_of(page(("Lei 1", "a"))).write.parquet(source)
    follow()
    pages_of(page(("Lei 9", "b"))).write.mode("overwrite").parquet(source)
    follow(checkpoint="another")
    assert [r[0] for r in stored(spark, out)] == ["Lei 0", "Lei 1", "Lei 9"]


def test_batches_do_not_change_the_base(spark, pages_of, tmp_path, follow):
    card = "<ul><li><a href='http://host.example/dir/{}'>um</a><p>resumo</p></li></ul>"
    htmls = [card.format(1), "<article><h1>T1</h1><p>corpo</p></article>", page(("Lei 1", "a")), card.format(3)]
    pages_of(*htmls).repartition(4).write.parquet(str(tmp_path / "pages"))
    for n in (1, 1000):
        follow(checkpoint=f"cp{n}", out=f"out{n}", max_files=n)
    bases = [stored(spark, str(tmp_path / f"out{n}")) for n in (1, 1000)]
    assert bases[0] == bases[1] and {r[:2] for r in bases[0]} == {("T1", "corpo"), ("Lei 1", "a"), ("um", "resumo")}


def test_a_failed_run_of_a_stream_is_made_up_for(spark, pages_of, tmp_path, follow, monkeypatch):
    pages_of(page(("Lei 1", "a"))).write.parquet(str(tmp_path / "pages"))
    with monkeypatch.context() as m:
        m.setattr(daily_run, "run_report", lambda counts: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            follow()
    assert follow().first().stored == 1


def test_quarantine_and_replay(spark, tmp_path, monkeypatch):
    """Pages that fail are kept as they came; a replay adds only what was missing, and keeps what fails again."""
    out, acts = str(tmp_path), [page(("Lei 1", "a")), page(("Lei 2", "b")), page(("Lei 3", "c")), "<p>\\ud800</p>"]
    rows = [(k, "", bytearray(h.encode()), "unicode_escape" if k == 3 else None) for k, h in enumerate(acts)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html binary, charset string")

    def broken(html, url, request):
        if "Lei 2" in html:
            raise RuntimeError("no")
        return page_elements(html, url, request)

    with monkeypatch.context() as m:
        m.setattr(nodes, "page_elements", broken)
        first = daily_run.run(pages, out, DAY1, "1", strict=True).first()
    assert (first.unreadable_pages, first.stored) == (2, 2) and [r[0] for r in stored(spark, out)] == ["Lei 1", "Lei 3"]
    waiting = {r.page_id: r for r in daily_run.quarantined(spark, out).collect()}
    assert set(waiting) == {1, 3} and bytes(waiting[1].html) == acts[1].encode() and "RuntimeError" in waiting[1].error
    again = daily_run.replay(spark, out, DAY2, "again").first()
    assert (again.unreadable_pages, again.stored) == (1, 3)
    assert [r[0] for r in stored(spark, out)] == ["Lei 1", "Lei 3", "Lei 2"]
    assert [bytes(r.html) for r in daily_run.quarantined(spark, out).collect()] == [acts[3].encode()]
    assert daily_run.replay(spark, out, DAY2, "third") is None and daily_run.quarantined(spark, out).count() == 1


def test_a_pass_shuffles_its_rows_once(spark, tmp_path):
    rows = spark.createDataFrame([(f"{k % 5}", *["x"] * 8, (1, "r", k, 0)) for k in range(20)], daily_run.RECORDS)
    keyed = rows.withColumn("key", daily_run.digest(daily_run.PRIMARY_KEYS))
    known = keyed.where("Ato = '3'").select("key").limit(1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with KeyLevels(spark, [], 8) as levels:
            plan = daily_run.exact_pass(rows, levels, spark.createDataFrame([], daily_run.REMOVED), True)
            whole = [x for x in plan._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(" in x]
            assert not any("xxhash64" in x for x in whole)
            assert sorted((r["Ato"], r["seq"].page_id) for r in plan.collect()) == [(f"{k}", k) for k in range(5)]
        left = daily_run._first_new(keyed, known).collect()
        assert sorted((r["Ato"], r["seq"].page_id) for r in left) == [("0", 0), ("1", 1), ("2", 2), ("4", 4)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_keys_of_a_kind_lie_together(spark, tmp_path):
    rows = [(kind, bytes([k, k]), (1, "r", k, 0), False) for k in range(40) for kind in ("normal", "exact", "exact_null")]
    path = str(tmp_path / "keys")
    key_levels.write_bucketed(spark.createDataFrame(rows, key_levels.KEYS), path, "key", 2)
    for f in sorted(os.listdir(path)):
        if f.endswith(".parquet"):
            kinds = [r.kind for r in spark.read.parquet(f"{path}/{f}").coalesce(1).collect()]
            assert len(kinds) > 3 and kinds == sorted(kinds)


def test_records_are_written_once(spark, pages_of, tmp_path, monkeypatch):
    """The batch folder is the table that a run works on; pages are written once too."""
    stores, store = [], daily_run.Staging.store
    monkeypatch.setattr(daily_run.Staging, "store", lambda self, df, name, **o: (stores.append(name), store(self, df, name, **o))[1])
    out = str(tmp_path)
    assert daily_run.run(pages_of(page(("Lei 1", "x"))), out, DAY1, "1", strict=True).first().stored == 1
    assert daily_run.run(pages_of("<article><h1>a</h1></article>"), out, DAY1, "2", strict=True) is None
    assert len(os.listdir(tmp_path / "batch")) == 1 and len(os.listdir(tmp_path / "linked")) == 2
    assert "nodes" in stores and not {"items", "captured"} & set(stores)
