"""The monthly run over synthetic exports of all families."""

from __future__ import annotations

import shutil
from types import SimpleNamespace

import pytest
from fixtures import CANCEL_1, CANCEL_HEADER, CONFIG, PMF_CASES, SALT, write_csv, write_exports, write_taxonomy
from pyspark.sql import functions as F

from hearback.operators import records
from hearback.plans import cancel_flow, recipes, refunds, tickets
from hearback.plans.family import KEY, Run, bind, sequence
from hearback.plans.ingest import ingest, leak_check
from hearback.queries import families
from hearback.session import Inline, Workspace, folders_in
from hearback.settings import Settings, load_taxonomy
from hearback.sources import exports, listing, people, published, search


@pytest.fixture(scope="module")
def place(tmp_path_factory):
    return tmp_path_factory.mktemp("ingest")


@pytest.fixture(scope="module")
def settings():
    return Settings.from_config(CONFIG, SALT)


@pytest.fixture(scope="module")
def taxonomy(place):
    return load_taxonomy(write_taxonomy(place / "taxonomy.json"))


@pytest.fixture(scope="module")
def run(spark, place, settings, taxonomy):
    write_exports(place / "raw")
    return ingest(spark, str(place / "raw"), str(place / "out"), settings, taxonomy, str(place / "work"))


@pytest.fixture(scope="module")
def table(spark, place, run):
    return lambda name: published.read_table(spark, str(place / "out"), name)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_all_files_reconcile(run, table):
    assert run.ok and run.published
    got = {r["file"].split("/")[-1]: r for r in table("reconciliation").collect()}
    assert len(got) == 16 and all(r["ok"] for r in got.values())
    counts = {name: (r["rows_read"], r["rows_loaded"], r["rows_rejected"]) for name, r in got.items()}
    assert counts["cancel [1].csv"] == (6, 3, 3)  # the blank last line is a record
    assert counts["_cancel.csv"] == (2, 1, 1)
    assert counts["empty.csv"] == counts["header only.csv"] == (0, 0, 0)
    assert counts["nps + non-bcm (1).csv"] == (5, 3, 2)
    assert counts["tickets.csv"] == (6, 3, 3)
    assert counts["broken.pdf"] == (1, 0, 1)


def test_rejects(table):
    assert rows(table("rejects"), "source", "row_number", "excluded_reason") == [
        ("chargebee", 1, "duplicate"), ("chargebee", 3, "empty_row"), ("chargebee", 4, "duplicate"),
        ("chargebee", 6, "empty_row"), ("documents", 1, "unreadable"), ("freshdesk", 2, "sender_internal"),
        ("freshdesk", 3, "sender_automated"), ("freshdesk", 5, "duplicate"), ("lyssna", 3, "duplicate"),
        ("mbg", 2, "duplicate"), ("sprig", 4, "staff_response"), ("sprig", 5, "duplicate"),
    ]


def test_cancellations(table):
    got = by(table("cancellations"), "session_id")
    assert set(got) == {"s1", "s2", "s3", "s4"}
    first, second = got["s1"], got["s2"]
    assert (first["user_id"], first["billing_customer_ref"], first["audience"]) == ("101", None, "book_club_member")
    assert (first["details"], first["mrr_usd"], first["return_likelihood"]) == ("[name] said call [phone]", 1234.5, 7.0)
    assert str(first["cancel_at"]) == "2026-07-03 10:00:00.250000"
    assert '"Coupon Codes":"SAVE10"' in first["raw"] and "mail.com" not in first["raw"]
    assert second["user_id"] is None and second["billing_customer_ref"].startswith("cb_")
    assert str(second["cancel_at"]) == "2026-07-04 11:00:00"  # start time stands in
    assert second["details"] == 'Line one\nline "two" from [name]'


def test_survey_answers(table):
    got = {(r["response_id"], r["question_no"]): r for r in table("sprig_answers").collect() if r["response_id"].startswith("r")}
    assert set(got) == {("r1", 1), ("r1", 2), ("r1", 3), ("r2", 1), ("r2", 2), ("r3", 1), ("r3", 3)}
    assert got["r1", 2]["question"] == "Why that score?"
    assert got["r1", 2]["themes"] == ["Too expensive"]
    assert got["r1", 2]["response"] == "Great, [name] [name] told me"
    assert (got["r1", 3]["choices"], got["r1", 3]["response_other"]) == (["Phone"], "other device")
    assert got["r2", 2]["skipped"] and got["r2", 2]["response"] is None
    assert got["r3", 3]["choices"] == ["my pad"]


def test_survey_responses(table):
    got = by(table("sprig_responses"), "response_id")
    assert got["r1"]["survey_family"] == "NPS" and got["A0"]["survey_family"] == "PMF"
    assert (got["r1"]["segment"], got["r1"]["channel"], got["r2"]["channel"]) == ("Non-BCM", "app", "web")
    assert got["r1"]["href"] == "https://x.test/?mail=[email]"
    assert got["r1"]["attributes"] == '{"appVersion":"3.1","planId":"p1"}'
    assert got["r3"]["created_at"] is None


def test_tickets_and_refunds(table):
    tickets, refunds = by(table("tickets"), "ticket_id"), list(by(table("refunds"), "request_id").values())
    assert tickets["1"]["subject"] == "Cancel my plan - [name]"
    assert tickets["1"]["body"] == "Hi [name],\nplease refund me.\n\n[name]"
    assert tickets["1"]["user_id"] == "101"  # from the cancel flow, by the same address
    assert (tickets["4"]["sender_type"], tickets["4"]["user_key"]) == ("payment_dispute", None)
    assert tickets["4"]["body"] == "The billing agreement for [name] was canceled. [name] <[email]> at once."
    assert tickets["5"]["created_at"] is None
    assert sorted((r["amount_usd"] or 0, r["notes_sent_email"], r["user_id"]) for r in refunds) == [
        (0, None, None), (39.99, "sent to [email]", "101"),
    ]


def test_panel_interviews_documents(table):
    assert rows(table("lyssna_answers"), "response_id", "column_index", "question", "field")[:2] == [
        ("p1", 5, "Do you read?", "Answer"), ("p1", 6, "What did you think?", "Answer"),
    ]
    tracker = {r["notes"]: r for r in table("interviews").collect()}
    assert tracker["mail [email]"]["snapshot"] == "[name] likes book clubs. [name] was charged."
    assert '"Interview recording link":"[removed]"' in tracker["mail [email]"]["raw"]
    doc = table("documents").first()
    assert (doc["title"], doc["doc_type"], doc["folder"], doc["initiative"]) == ("deck one", "md", "Interviews", "NPS")
    assert doc["text"] == "Insights about the NPS by [name], mail [email]"


def test_evidence(table):
    got = {(r["source"], r["record_id"], r["sub_id"]): r for r in table("evidence").collect()}
    assert len({r["evidence_id"] for r in got.values()}) == len(got)
    s1 = got["chargebee", "s1", None]
    assert (s1["area"], s1["theme"], s1["theme_method"]) == ("price", "too_expensive", "source_map")
    assert s1["text"] == "[name] said call [phone] | Competitor: Rival" and s1["segment"] == "BCM"
    assert (got["chargebee", "s2", None]["area"], got["chargebee", "s2", None]["theme_method"]) == ("billing", "text_rule")
    assert got["chargebee", "s3", None]["theme_method"] == "none"
    themed = got["sprig", "r1", "2"]
    assert (themed["area"], themed["theme"], themed["theme_method"]) == ("price", "Too expensive", "source_theme")
    nps = got["sprig", "r1", "1"]
    assert (nps["score"], nps["score_type"], nps["category"], nps["answer_type"]) == (9.0, "nps_0_10", "Promoter", "score")
    pick = got["sprig", "r3", "3"]
    assert (pick["text"], pick["theme"], pick["answer_type"]) == ("my pad", "my pad", "choice")
    assert ("sprig", "r2", "2") not in got  # only skipped
    assert got["sprig", "A0", "1"]["theme_method"] == "question_rule"
    assert got["freshdesk", "4", None]["theme"] == "payment_dispute"
    panel = [r for k, r in got.items() if k[0] == "lyssna"]
    assert [(r["population"], r["area"], r["sub_id"]) for r in panel] == [("panel", "assistant", "6")]


def test_people(table):
    users = {r["user_id"]: r for r in table("users").collect() if r["user_id"]}
    ann = users["101"]
    assert ann["sources"] == ["chargebee", "freshdesk", "mbg"] and ann["evidence_items"] == 4
    assert (ann["audience"], ann["plan"]) == ("book_club_member", "silver")
    pairs = rows(table("identity_map"), "user_id", "observations", "is_primary", "ambiguous")
    assert pairs == [("101", 2, True, False), ("103", 1, True, False), ("104", 1, True, False)]


def test_golden_top_box(table):
    shares = {r["instrument"][-1]: (r["n"], r["pct_very"]) for r in recipes.pmf_share(table("evidence")).collect()}
    assert shares == {case: (sum(counts), share) for case, (counts, share) in PMF_CASES.items()}


def test_report(spark, place, run):
    def part(name):
        return published.read_manifest(spark, str(place / "out"), name)

    alerts = {r["alert"] for r in part("alerts").collect()}
    assert "unhandled file (not ingested): 2026-08/notes.xlsx" in alerts
    assert "unhandled file (not ingested): 2026-08/loose.csv" in alerts
    assert "documents: could not read 2026-08/broken.pdf" in alerts
    assert "mbg: unmapped column 'Favourite colour' in refunds.csv (kept in mirror only)" in alerts
    assert "sprig: 1 unparsed dates in nps + non-bcm (1).csv" in alerts
    assert "freshdesk: 1 unparsed dates in tickets.csv" in alerts
    assert not any("hidden" in a or "other/x" in a or a.startswith(("schema", "volume")) for a in alerts)
    head = part("run").first()
    assert (head["months"], head["files"], head["taxonomy_version"]) == (["2026-07", "2026-08"], 16, "3")
    assert ("sprig", "2026-08", 141, 5) in rows(part("by_source_month"), "source", "period", "rows_read", "files")
    assert ("evidence", 158) in rows(part("tables"), "table_name", "rows")


def test_mirror_and_provenance(spark, place, table):
    mirror = published.read_mirror(spark, str(place / "out"))
    assert mirror.count() == 169  # every record of every readable file
    ticket = table("evidence").filter("source = 'freshdesk' AND record_id = '1'")
    record = recipes.original_record(ticket, mirror).first()
    assert {c["column"]: c["value"] for c in record["cells"]}["User"].startswith("u_")


def test_no_personal_data_left(spark, place, settings, run):
    leaks = leak_check(spark, str(place / "raw"), str(place / "out"), settings, str(place / "work"))
    assert rows(leaks, "where", "kind", "n") == []


def test_sizes_come_from_the_writes(spark, place, run, table):
    got = by(run.manifest["tables"], "table_name")
    assert got and all(r["rows"] == table(name).count() for name, r in got.items())


def test_nothing_raw_is_left_after_a_run(spark, place, settings, taxonomy, monkeypatch):
    used = []

    class Noted(Workspace):
        def __init__(self, *args):
            super().__init__(*args)
            used.append(self.root)

    monkeypatch.setattr("hearback.plans.ingest.Workspace", Noted)
    root, out, work = small(place, "raw8", [CANCEL_HEADER, ["x1"]]), str(place / "out8"), str(place / "work8")
    result = ingest(spark, root, out, settings, taxonomy, work)
    assert result.published and folders_in(spark, used[0]) == []
    assert result.tables["cancellations"].count() == 4 and result.manifest["alerts"].count() >= 0
    dry = ingest(spark, root, out, settings, taxonomy, work, dry_run=True)
    assert dry.tables["cancellations"].count() == 4 and folders_in(spark, used[1]) != []


def test_old_runs_are_removed_unless_a_reader_holds_them(spark, tmp_path):
    out, runs = str(tmp_path / "out"), []
    for i in range(4):
        runs.append(published.new_run())
        spark.range(i).write.parquet(f"{out}/{runs[i]}/data/studies")
        published.make_current(spark, out, runs[i])
        if i == 1:
            reading = published.hold(spark, out, "report")
    (tmp_path / "out" / "runs" / "failed").mkdir()
    assert published.published_runs(spark, out) == runs[::-1] and reading == f"{out}/{runs[1]}"
    assert published.remove_old_runs(spark, out, keep=1) == sorted([runs[0], runs[2]])  # the failed one is too young
    assert spark.read.parquet(f"{reading}/data/studies").count() == 1
    assert published.remove_old_runs(spark, out, keep=1, failed_after_hours=-1) == ["runs/failed"]
    published.hold(spark, out, "nobody", hours=-1)
    assert published.remove_old_runs(spark, out, keep=0) == [] and published.current(spark, out) == f"{out}/{runs[3]}"
    assert published.remove_old_runs(spark, str(tmp_path / "nowhere")) == []


def test_lasting_views(spark, place, run, table):
    spark.sql("CREATE DATABASE IF NOT EXISTS lasting LOCATION '" + str(place / "lasting") + "'")
    published.persist_views(spark, str(place / "out"), "lasting")
    other = spark.newSession()
    assert other.sql("SELECT count(*) FROM lasting.evidence").first()[0] == table("evidence").count()
    assert other.table("lasting.tickets").schema == table("tickets").schema


def test_a_look_up_reads_the_row_groups_of_its_file(spark, tmp_path, monkeypatch):
    """Mirror rows lie by file, and the filters of file names keep other row groups from being read."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(published, "MIRROR_BLOCK", 16 * 1024)
    cells = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.struct(F.lit("c").alias("column"), F.lit("l").alias("label"), F.sha2(F.concat("id", i), 256).alias("value")))
    df = spark.range(20_000).select(
        F.lit("2026-07").alias("period"), F.lit("freshdesk").alias("source"),
        F.concat(F.lit("2026-07/f"), F.lpad((F.col("id") % 400).cast("string"), 3, "0")).alias("source_file"), F.col("id").alias("row_number"), cells.alias("cells"),
    )
    published.publish_mirror(df, str(tmp_path))
    files = [pq.ParquetFile(p).metadata for p in (tmp_path / "mirror").rglob("*.parquet")]
    groups = [m.row_group(g) for m in files for g in range(m.num_row_groups)]
    spans = [(g.column(0).statistics.min, g.column(0).statistics.max, g.num_rows) for g in groups]
    asked = "2026-07/f123"
    hit = [n for low, high, n in spans if low <= asked <= high]
    assert len(groups) > 10 and len(hit) <= 2 and sum(hit) < 20_000 / 4
    mirror = spark.read.schema(published.MIRROR_SCHEMA).parquet(f"{tmp_path}/mirror")
    wanted = spark.createDataFrame([("2026-07", "freshdesk", asked, 123)], "period string, source string, source_file string, row_number long")
    assert recipes.original_record(wanted, mirror).count() == 1
    plan = mirror.filter(F.col("source_file") == asked)._jdf.queryExecution().toString()
    assert f"EqualTo(source_file,{asked})" in plan


def test_views_and_sql(spark, place, run):
    published.register_views(spark, str(place / "out"))
    got = spark.sql(
        "SELECT source, count(*) n FROM evidence WHERE population = 'user' AND array_contains(areas, 'billing') "
        "GROUP BY ALL ORDER BY n DESC, source"
    ).collect()
    assert {r["source"]: r["n"] for r in got} == {"chargebee": 1, "freshdesk": 2, "interviews": 1}


def small(place, name, rows_2):
    """One family only: a file of three records and one given."""
    root = place / name
    write_csv(root / "2026-07" / "Chargebee" / "a.csv", [CANCEL_HEADER, *CANCEL_1[:2], CANCEL_1[4]])
    write_csv(root / "2026-08" / "Chargebee" / "b.csv", rows_2)
    return str(root)


def test_second_run_reports_drift_and_volume(spark, place, settings, taxonomy):
    out, work = str(place / "out2"), str(place / "work")
    root = small(place, "raw2", [CANCEL_HEADER, ["x1"], ["x2"]])
    assert ingest(spark, root, out, settings, taxonomy, work).published
    before = rows(published.read_table(spark, out, "evidence"), "evidence_id", "user_id", "area")
    again = ingest(spark, root, out, settings, taxonomy, work)
    assert rows(published.read_table(spark, out, "evidence"), "evidence_id", "user_id", "area") == before
    assert again.manifest["alerts"].filter("alert LIKE 'schema%' OR alert LIKE 'volume%'").count() == 0
    shutil.copy(place / "raw2" / "2026-08" / "Chargebee" / "b.csv", place / "raw2" / "2026-08" / "Chargebee" / "c.csv")
    write_csv(place / "raw2" / "2026-08" / "Chargebee" / "d.csv", [["exit_session_id", "Extra"], ["y1", "e"], ["y2", "f"]])
    alerts = {r["alert"] for r in ingest(spark, root, out, settings, taxonomy, work, dry_run=True).manifest["alerts"].collect()}
    assert "schema: chargebee has new columns ['Extra']" in alerts
    assert "volume: chargebee 2026-08 rows 2 -> 6" in alerts
    assert published.read_table(spark, out, "cancellations").count() == 5  # the dry run wrote nothing


def test_gate_publishes_nothing(spark, place, settings, taxonomy, monkeypatch):
    monkeypatch.setattr(records, "all_ok", lambda reconciliation: False)
    root = small(place, "raw3", [CANCEL_HEADER])
    result = ingest(spark, root, str(place / "out3"), settings, taxonomy, str(place / "work"))
    assert not result.ok and not result.published
    assert not (place / "out3").exists()


def test_a_missing_or_empty_folder_leaves_what_was_published(spark, place, settings, taxonomy):
    out, work = str(place / "out5"), str(place / "work")
    assert ingest(spark, small(place, "raw5", [CANCEL_HEADER]), out, settings, taxonomy, work).published
    with pytest.raises(FileNotFoundError):
        ingest(spark, str(place / "nowhere"), out, settings, taxonomy, work)
    (place / "hollow" / "2026-07").mkdir(parents=True)
    (place / "hollow" / "2026-07" / "notes.xlsx").write_bytes(b"zip")
    result = ingest(spark, str(place / "hollow"), out, settings, taxonomy, work)
    assert not result.ok and not result.published
    assert published.read_table(spark, out, "cancellations").count() == 3


def test_a_file_that_does_not_reconcile_publishes_nothing(spark, place, settings, taxonomy, monkeypatch):
    out, work = str(place / "out6"), str(place / "work")
    root = small(place, "raw6", [CANCEL_HEADER])
    assert ingest(spark, root, out, settings, taxonomy, work).published
    keep = cancel_flow.loaded
    monkeypatch.setattr(cancel_flow, "loaded", lambda shaped: keep(shaped).filter("record_id <> 's2'"))
    result = ingest(spark, root, out, settings, taxonomy, work)
    assert not result.ok and not result.published
    failed = result.manifest["reconciliation_failures"].collect()
    assert [(r["file"], r["rows_read"], r["rows_loaded"], r["rows_rejected"]) for r in failed] == [("2026-07/Chargebee/a.csv", 3, 2, 0)]
    assert published.read_table(spark, out, "cancellations").count() == 3


def test_file_systems_by_scheme(tmp_path):
    from hearback.sources.listing import filesystem

    assert filesystem(str(tmp_path))[1] == str(tmp_path)
    assert filesystem(f"file://{tmp_path}")[1] == filesystem(f"file:{tmp_path}")[1] == str(tmp_path)
    with pytest.raises(ValueError):
        filesystem("dbfs:/mnt/raw")


def test_places_beyond_their_bits_fail(spark):
    df = spark.createDataFrame([(1 << 28, 1)], "file_no long, row_number long")
    with pytest.raises(Exception, match="processing order"):
        df.select(sequence().alias("s")).collect()
    df = spark.createDataFrame([((1 << 28) - 1, (1 << 35) - 1), (3, 0)], "file_no long, row_number long")
    assert [r["s"] for r in df.select(sequence().alias("s")).collect()] == [(1 << 63) - 1, 3 << 35]


def test_tasks_follow_bytes(spark, monkeypatch):
    from hearback.sources import exports

    monkeypatch.setattr(exports, "TASK_BYTES", 100)
    sizes = [90, 5, 5, 300, 10, 90]
    rows_ = [("2026-07", "mbg", f"f{i}", i, s, sum(sizes[:i])) for i, s in enumerate(sizes)]
    files = spark.createDataFrame(rows_, "period string, source string, source_file string, file_no long, size long, bytes_before long")
    got = exports._spread(files).select("source_file", F.spark_partition_id().alias("p")).collect()
    assert {r["source_file"]: r["p"] for r in got} == {"f0": 0, "f1": 0, "f2": 0, "f3": 1, "f4": 4, "f5": 4}


def test_a_write_that_fails_leaves_the_last_run(spark, place, settings, taxonomy, monkeypatch):
    out, work = str(place / "out7"), str(place / "work")
    root = small(place, "raw7", [CANCEL_HEADER])
    assert ingest(spark, root, out, settings, taxonomy, work).published
    monkeypatch.setattr(published, "publish_mirror", lambda *a: 1 / 0)
    write_csv(place / "raw7" / "2026-08" / "Chargebee" / "c.csv", [CANCEL_HEADER, ["x9"]])
    with pytest.raises(ZeroDivisionError):
        ingest(spark, root, out, settings, taxonomy, work)
    assert published.read_table(spark, out, "cancellations").count() == 3


def test_reports_only(spark, place, settings, taxonomy):
    (place / "raw4" / "2026-07").mkdir(parents=True)
    (place / "raw4" / "2026-07" / "notes.txt").write_text("call 555-123-4567", encoding="utf-8")
    out = str(place / "out4")
    result = ingest(spark, str(place / "raw4"), out, settings, taxonomy, str(place / "work"))
    assert result.published
    assert rows(published.read_table(spark, out, "documents"), "text", "folder") == [("call [phone]", None)]
    assert published.read_table(spark, out, "evidence").count() == 0
    assert published.read_table(spark, out, "users").count() == 0


def test_run_state_may_be_missing_or_broken(spark, place):
    assert published.read_manifest(spark, str(place / "nowhere"), "schema_snapshot").count() == 0
    broken = place / "broken" / "manifest" / "by_source_month"
    broken.mkdir(parents=True)
    (broken / "part-0.json").write_text("{ not json\n", encoding="utf-8")
    assert published.read_manifest(spark, str(place / "broken"), "by_source_month").count() == 0


def test_missing_ticket_columns_are_reported(spark):
    heads = spark.createDataFrame([("m/f/t.csv", ["Date", "User", "Feedback"])], "source_file string, header array<string>")
    alerts = [r["alert"] for r in tickets.missing_columns(heads).collect()]
    assert alerts == ["freshdesk: t.csv missing columns Ticket ID, Segmentation"]


def test_work_folder_comes_from_the_session():
    def session(**conf):  # the setting cannot be changed on a running session
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf.get(key.replace(".", "_"), default)))

    assert Workspace(session(spark_checkpoint_dir="/shared"), "/elsewhere").root.startswith("/shared/")
    assert Workspace(session(), "/elsewhere").root.startswith("/elsewhere/")
    with pytest.raises(ValueError):
        Workspace(session())


def test_repeats_through_the_shuffle_path(spark):
    """Side tables beyond the broadcast limit give the same flags."""
    df = spark.createDataFrame([(i, f"k{i % 7}") for i in range(50)], "seq long, id string")
    plain = records.mark_repeats(df, ["id"], "seq")
    settled = records.mark_repeats(df, ["id"], "seq", settle=lambda found: found)
    assert rows(plain, "seq", "is_repeat") == rows(settled, "seq", "is_repeat")


def test_layouts_follow_headers_and_not_files(spark, settings):
    shapes = [tickets.REQUIRED, tickets.REQUIRED[::-1], [*tickets.REQUIRED, "Agent notes"]]
    keys = [exports.header_key("freshdesk", [h]) for h in shapes]
    assert len(set(keys)) == 3 and exports.header_key("sprig", [shapes[0]]) != keys[0]
    number = F.col("id") % 10_000
    header = F.get(F.array(*[F.array(*[F.lit(c) for c in h]) for h in shapes]), (number % 3).cast("int"))
    raw = spark.range(40_000).select(
        F.lit("2026-07").alias("period"),
        F.lit("freshdesk").alias("source"),
        F.format_string("2026-07/Freshdesk/%d.csv", number).alias("source_file"),
        number.alias("file_no"),
        F.get(F.array(*[F.lit(k) for k in keys]), (number % 3).cast("int")).alias(KEY),
        F.floor(F.col("id") / 10_000).alias("row_number"),
        F.when(F.col("id") < 10_000, header).otherwise(F.transform(header, lambda c: F.concat(c, F.lit("!")))).alias("cells"),
    )
    run = Run(settings, Inline(spark), raw, exports.headers_of(raw))
    assert run.heads("freshdesk").count() == 10_000
    found = tickets.layout(run.layouts("freshdesk"))
    assert sorted(r["header"] for r in found.collect()) == sorted(shapes)
    bound = bind(run, "freshdesk", found)
    got = bound.select(tickets.COLS.raw("Ticket ID").alias("id"), tickets.COLS.raw("Date").alias("at"))
    assert got.groupBy("id", "at").count().collect() == [("Ticket ID!", "Date!", 30_000)]
    # the rows meet their layout where they lie: what is shuffled are header rows
    text = bound._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    run.layouts_small, run.hot_rows = False, 5_000  # too many headers to broadcast: one of a third of all rows is spread
    spread = bind(run, "freshdesk", found).select(tickets.COLS.raw("Ticket ID").alias("id"))
    assert spread.groupBy("id").count().collect() == [("Ticket ID!", 30_000)]


def test_header_work_of_exports_is_not_done_for_each_record(spark):
    """Below the aggregate that finds the files of an export, nothing of a header is worked out."""
    rows = spark.range(20).select("id", F.when(F.col("id") % 4 > 0, F.concat(F.lit("f"), F.col("id") % 4)).alias("file"))
    asked = families.as_export(spark, rows, "mbg", F.col("file"), F.col("id"), {"Amount": F.col("id"), "Colour": F.lit("red")})
    found = refunds.unmapped_columns(asked.heads("mbg"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" in plan and "lambda" not in plan[plan.index("Aggregate [") :].split("\n", 1)[1]
    got = sorted(r["alert"] for r in found.collect())
    assert got == [f"mbg: unmapped column 'Colour' in {f} (kept in mirror only)" for f in ("f1.csv", "f2.csv", "f3.csv", "null")]


def test_names_of_exports_that_are_no_numbers_are_not_cast(spark):
    """A cast that fails costs an exception for each row; file numbers stay what they were."""
    want = {"12": 12, " 7 ": 7, "+5": 5, "-3": -3, "A": 65, "x1": 120, "1 2": 49, "9" * 20: 57, "\t8\n": 8, "": 0, None: None}
    rows = spark.createDataFrame(list(enumerate(want)), "id long, file string")
    raw = families.as_export(spark, rows, "mbg", F.col("file"), F.col("id"), {"Amount": F.col("id")}).raw
    assert {list(want)[r["row_number"] - 1]: r["file_no"] for r in raw.collect()} == want
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") == plan.count("THEN try_cast(") == 1


def test_listing_finds_every_file_at_any_depth(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "ENTRIES", 2)
    names = ["top.txt", "2026-07/a.csv", "2026-07/_Export/b [1].csv", "2026-07/Export/deep/er/c.csv", "2026-08/Export/.hidden"]
    names += [f"2026-08/Many/{i}.csv" for i in range(7)]
    for i, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x" * i)
    (tmp_path / "2026-09" / "empty").mkdir(parents=True)
    for root in (str(tmp_path), f"{tmp_path}/", f"file://{tmp_path}"):
        assert rows(listing.list_files(spark, root), "source_file", "size") == sorted(zip(names, range(len(names))), key=repr)
    bare = tmp_path / "2026-09" / "empty"
    assert listing.list_files(spark, str(bare)).collect() == []
    with pytest.raises(FileNotFoundError):
        listing.list_files(spark, str(tmp_path / "none"))


def test_people_and_index_of_a_run(spark, place, table):
    out = str(place / "out")
    evidence, acted = table("evidence"), people.read_people(spark, out)
    total = acted.agg(F.sum("n")).first()[0]
    assert total == evidence.count()
    want = rows(recipes.area_across_sources(evidence, "price"), "source", "n", "people")
    assert rows(recipes.area_across_sources(acted, "price", "n"), "source", "n", "people") == want and want
    search.index_table(spark, out)
    hit = F.col("text").ilike("%rival%")
    near = search.table_near(spark, out, "evidence", "rival")
    assert rows(near.filter(hit), "evidence_id") == rows(evidence.filter(hit), "evidence_id") != []
    plain = search.table_near(spark, out, "documents", "nps")  # no index was made for it
    assert plain.count() == table("documents").count()
