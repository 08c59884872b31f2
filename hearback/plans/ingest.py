"""The monthly run: exports in, published tables out."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, identity, names, quality, records
from ..operators.classify import Taxonomy
from ..schemas import TABLES
from ..session import BROADCAST_BYTES, Workspace
from ..settings import Settings
from ..sources import exports, listing, published
from ..sources import people as people_by_key
from . import cancel_flow, interviews, panel, refunds, reports, surveys, tickets
from .evidence import build_evidence, union_all
from .family import KEY, SEQ, Output, Run, mirror, rejects

# Export families; a family module has build(run) and, when its records name
# people, people(run). A new family is one more entry.
FAMILIES = {
    "chargebee": cancel_flow,
    "freshdesk": tickets,
    "interviews": interviews,
    "lyssna": panel,
    "mbg": refunds,
    "sprig": surveys,
}

# Table holding the loaded records of each source.
RECORD_TABLES = {
    "chargebee": "cancellations",
    "freshdesk": "tickets",
    "interviews": "interviews",
    "lyssna": "lyssna_participants",
    "mbg": "refunds",
    "sprig": "sprig_responses",
    "documents": "documents",
}


LAYOUT_BYTES_PER_COLUMN = 400


@dataclass
class Result:
    """Outcome of a run. ``tables`` and ``manifest`` are lazy tables over the run's folder once it is
    published, and over the work folder otherwise. The registry of names goes with the work folder."""

    ok: bool
    published: bool
    tables: dict[str, DataFrame] = field(default_factory=dict)
    manifest: dict[str, DataFrame] = field(default_factory=dict)
    registry: DataFrame | None = None


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, counted by reading them; a run that publishes takes them from its writes."""
    return union_all(
        [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    )


def read_exports(spark: SparkSession, root: str, settings: Settings, work: Workspace) -> tuple[Run, DataFrame]:
    """Scan all export files once into the work folder, with their headers and names."""
    files = work.stage(listing.with_origin(listing.list_files(spark, root), settings), "files")
    csv = files.filter(F.col("source").isin(list(FAMILIES)))
    raw = work.stage(exports.scan_csv(csv, root), "raw", partition_by=("source",))
    headers = work.stage(exports.headers_of(raw), "headers")
    run = Run(settings, work, raw, headers)
    # a layout is a few arrays as long as the header, and files of one header share it
    cells = headers.dropDuplicates([KEY]).agg(F.sum(F.size("header"))).first()[0] or 0
    run.layouts_small = cells * LAYOUT_BYTES_PER_COLUMN <= BROADCAST_BYTES
    present = {r["source"] for r in headers.select("source").distinct().collect()}
    found = [FAMILIES[s].people(run) for s in sorted(present) if hasattr(FAMILIES[s], "people")]
    if found:
        run.registry = work.stage(names.name_registry(union_all(found)), "names")
        run.registry_rows = run.registry.count()
    return run, files


def build_families(run: Run, files: DataFrame, root: str) -> dict[str, Output]:
    present = {r["source"] for r in run.headers.select("source").distinct().collect()}
    outputs = {s: FAMILIES[s].build(run) for s in sorted(present)}
    documents = files.filter("source = 'documents'")
    texts = run.work.stage(exports.scan_text(documents, root), "texts")  # read once
    outputs["documents"] = reports.build(run, texts)
    return outputs


def observed_ids(tables: dict[str, DataFrame]) -> DataFrame | None:
    """Key and id pairs as cancel flow and surveys state them."""
    seen = [tables[t].select("user_key", "user_id", SEQ) for t in ("cancellations", "sprig_responses") if SEQ in tables[t].columns]
    return union_all(seen) if seen else None


def roll_up_users(evidence: DataFrame, primary: DataFrame) -> DataFrame:
    ordered = evidence.withColumn("_sub", F.coalesce(F.col("sub_id").try_cast("int"), F.lit(0)))
    people = identity.roll_up(
        ordered,
        "user_key",
        "source",
        "occurred_at",
        [SEQ, "_sub"],
        first={"audience": "audience"},
        last={"plan": "plan"},
    )
    return people.join(primary, "user_key", "left").withColumnRenamed("primary_id", "user_id")


def ingest(
    spark: SparkSession,
    root: str,
    out: str,
    settings: Settings,
    taxonomy: Taxonomy,
    work_dir: str | None = None,
    dry_run: bool = False,
    keep_work: bool = False,
) -> Result:
    """Rebuild everything from all month folders under ``root``.

    Nothing is written to ``out`` when any file fails to reconcile, or on a dry run. The work folder holds raw
    cells: it is removed when the run has been published, unless ``keep_work`` is set.
    """
    work = Workspace(spark, work_dir)
    run, files = read_exports(spark, root, settings, work)
    outputs = build_families(run, files, root)

    tables = {name: published.empty(spark, schema) for name, schema in TABLES.items()}
    for output in outputs.values():
        tables.update(output.tables)

    pairs, observed = tables["identity_map"], observed_ids(tables)
    if observed is not None:
        pairs = work.stage(
            identity.identity_map(
                observed, SEQ, hot_rows=run.hot_rows, stage=lambda counted: work.stage(counted, "id_pairs")
            ),
            "identity_map",
        )
    primary = identity.primary_of(pairs)
    tables["identity_map"] = pairs
    for name, key in (("tickets", "ticket_id"), ("refunds", "request_id"), ("interviews", "interview_id")):
        tables[name] = identity.backfill_user_id(
            tables[name].withColumn("user_id", F.lit(None).cast("string")),
            primary,
            spread_by=[key],
            overwrite=True,
            hot_rows=run.hot_rows,
        )

    items = [o.items for o in outputs.values() if o.items is not None]
    if items:
        known = identity.backfill_user_id(
            union_all(items), primary, spread_by=[SEQ, "sub_id"], hot_rows=run.hot_rows
        )
        tables["evidence"] = work.stage(build_evidence(known, taxonomy, carry=(SEQ,)), "evidence")
        tables["users"] = roll_up_users(tables["evidence"], primary)

    studies = [published.conform(o.studies, TABLES["studies"]) for o in outputs.values() if o.studies is not None]
    tables["studies"] = union_all(studies) if studies else tables["studies"]
    tables["rejects"] = work.stage(union_all([rejects(o.shaped, s) for s, o in outputs.items()]), "rejects")
    reconciliation = work.stage(reconcile_files(run, files, tables), "reconciliation")
    tables["reconciliation"] = reconciliation
    ok = records.all_ok(reconciliation)

    manifest = report(spark, out, run, files, tables, outputs, taxonomy, ok)
    result = Result(ok, False, tables, manifest, run.registry)
    if ok and not dry_run:
        publish(spark, result, outputs, out)
        result.published = True
        if not keep_work:
            result.registry = None
            work.remove()
    return result


def reconcile_files(run: Run, files: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Read, loaded and rejected rows per file from three tables: the raw scan, the
    published records and the rejects."""
    by = ["source", "period", "source_file"]
    handled = files.filter("source IS NOT NULL")
    read = run.raw.filter("row_number > 0").select(*by)
    read = read.unionByName(handled.filter("source = 'documents'").select(*by))
    loaded = union_all(
        [tables[t].select(F.lit(s).alias("source"), "period", "source_file") for s, t in RECORD_TABLES.items()]
    )
    counted = records.reconcile(handled, read, loaded, tables["rejects"].select(*by), by)
    return published.conform(counted.withColumnRenamed("source_file", "file"), TABLES["reconciliation"])


def report(
    spark: SparkSession,
    out: str,
    run: Run,
    files: DataFrame,
    tables: dict[str, DataFrame],
    outputs: dict[str, Output],
    taxonomy: Taxonomy,
    ok: bool,
) -> dict[str, DataFrame]:
    """Run report; every part is an aggregate that grows with files or sources only."""
    work = run.work
    reconciliation = tables["reconciliation"]
    volumes = work.stage(records.volumes(reconciliation), "volumes")
    snapshot = work.stage(quality.column_sets(run.headers), "schema_snapshot")
    evidence = tables["evidence"]

    drift = quality.schema_drift(
        snapshot, published.read_manifest(spark, out, "schema_snapshot"), ["source"], ignore=quality.expected_drift()
    )
    listed = F.array_join(F.slice(F.array_sort(F.collect_set("column")), 1, 10), "', '")
    verb = F.when(F.col("change") == "new", "has new").otherwise("lost")
    drift_alerts = drift.groupBy("source", "change").agg(listed.alias("columns")).select(
        F.format_string("schema: %s %s columns ['%s']", F.col("source"), verb, F.col("columns")).alias("alert")
    )
    swings = quality.volume_swings(
        volumes,
        published.read_manifest(spark, out, "by_source_month"),
        ["source", "period"],
        "rows_read",
        run.settings.volume_alert_ratio,
    )
    volume_alerts = swings.select(
        F.format_string(
            "volume: %s %s rows %d -> %d", F.col("source"), F.col("period"), F.col("rows_before"), F.col("rows_now")
        ).alias("alert")
    )
    unhandled = files.filter("source IS NULL").select(
        F.concat(F.lit("unhandled file (not ingested): "), F.col("source_file")).alias("alert")
    )
    alerts = union_all(
        [unhandled, drift_alerts, volume_alerts, *[a for o in outputs.values() for a in o.alerts or []]]
    )
    head = files.filter("source IS NOT NULL").agg(
        F.lit(datetime.now(timezone.utc).isoformat(timespec="seconds")).alias("run_at"),
        F.lit(taxonomy.version).cast("string").alias("taxonomy_version"),
        F.lit(taxonomy.content_hash).cast("string").alias("taxonomy_hash"),
        F.array_sort(F.collect_set("period")).alias("months"),
        F.lit(ok).alias("reconciliation_ok"),
        F.count("*").alias("files"),
    )
    users = evidence.filter("population = 'user'")
    return {
        "run": head,
        "by_source_month": volumes,
        "rejects_by_reason": records.reject_counts(tables["rejects"]),
        "tables": table_sizes({n: t for n, t in tables.items() if n != "reconciliation"}),
        "link_rates": quality.link_rates(evidence),
        "areas": users.groupBy("area").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "area"),
        "theme_methods": evidence.groupBy("theme_method").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "theme_method"),
        "alerts": work.stage(alerts, "alerts"),
        "schema_snapshot": snapshot,
        "reconciliation_failures": reconciliation.filter("NOT ok").select(
            "source", "period", "file", "rows_read", "rows_loaded", "rows_rejected"
        ),
    }


def publish(spark: SparkSession, result: Result, outputs: dict[str, Output], out: str) -> None:
    """Write everything to the run's own folder, then make it the current one."""
    run = published.new_run()
    base = f"{out}/{run}"
    rows = [(name, published.publish_table(df, base, name)) for name, df in result.tables.items()]
    counted = [(name, n) for name, n in rows if name != "reconciliation"]
    result.manifest["tables"] = spark.createDataFrame(counted, "table_name string, rows long")
    copies = [mirror(o.shaped, s) for s, o in outputs.items() if s != "documents"]
    if "documents" in outputs:
        copies.append(reports.mirror(outputs["documents"].shaped))
    published.publish_mirror(union_all(copies), base)
    published.write_manifest(result.manifest, base)
    people_by_key.publish_people(spark, base)
    published.make_current(spark, out, run)
    result.tables = {name: published.read_table(spark, out, name) for name in result.tables}
    parts = {name: (df.schema, f"{base}/manifest/{name}") for name, df in result.manifest.items()}
    result.manifest = {name: spark.read.schema(schema).json(path) for name, (schema, path) in parts.items()}


def leak_check(
    spark: SparkSession, root: str, out: str, settings: Settings, work_dir: str | None = None
) -> DataFrame:
    """Leaks left in the published tables and the mirror, by place and kind.

    Names come from a fresh scan of the exports, as in the run itself.
    """
    work = Workspace(spark, work_dir)
    run, _ = read_exports(spark, root, settings, work)
    registry = run.registry if run.registry is not None else published.empty(spark, "kind string, value string")
    tables = {f"data/{name}": published.read_table(spark, out, name) for name in TABLES}
    copy = published.read_mirror(spark, out).select(F.transform("cells", lambda c: c["value"]).alias("cells"))
    return audit.check_leaks({**tables, "mirror": copy}, registry, settings.allowed_domains)
