"""Text reports: one row per file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import masks
from ..functions.scalars import initiative_of, short_hash
from ..operators.names import capital_pairs, known_names
from .family import Output, Run, file_name, file_stem

SOURCE = "documents"


def build(run: Run, texts: DataFrame) -> Output:
    """``texts`` has period, source_file, text and readable, one row per file."""
    parts = F.split("source_file", "/")
    rows = texts.withColumn("row_number", F.lit(1).cast("long"))
    if run.registry is not None:
        keys = ["source_file"]
        known = known_names(
            rows,
            keys,
            capital_pairs(F.col("text")),
            run.registry,
            run.registry_rows,
            stage=lambda found: run.work.stage(found, f"pairs/{SOURCE}"),
            hot_rows=run.hot_rows,
        )
        rows = rows.join(known.drop("known_firsts"), keys, "left")
    else:
        rows = rows.withColumn("known_pairs", F.array().cast("array<string>"))
    shaped = run.work.stage(
        rows.withColumns(
            {
                "text": masks.scrub("text", None, F.col("known_pairs"), run.settings.stop_words),
                "reason": F.when(~F.col("readable"), "unreadable"),
                "record_id": file_name(),
            }
        ).drop("known_pairs"),
        f"shaped/{SOURCE}",
    )
    folder = F.when(F.size(parts) > 2, F.get(parts, F.size(parts) - 2))
    records = shaped.filter("reason IS NULL").select(
        F.concat(F.lit("doc_"), short_hash("period", "source_file")).alias("doc_id"),
        "period",
        folder.alias("folder"),
        file_name().alias("file_name"),
        F.replace(file_stem(), F.lit("_"), F.lit(" ")).alias("title"),
        F.lower(F.regexp_extract(file_name(), r"(?<=.)\.([^.]*)$", 1)).alias("doc_type"),
        initiative_of(file_name(), folder, F.left("text", F.lit(500)), rules=run.settings.initiatives).alias("initiative"),
        F.char_length("text").alias("chars"),
        "text",
        "source_file",
        "row_number",
    )
    studies = records.select(
        F.col("doc_id").alias("study_id"),
        F.lit("report").alias("kind"),
        F.col("title").alias("name"),
        "initiative",
        "period",
        F.lit(None).cast("long").alias("n"),
        "source_file",
    )
    unreadable = shaped.filter("reason IS NOT NULL").select(
        F.concat(F.lit("documents: could not read "), F.col("source_file")).alias("alert")
    )
    return Output(shaped, {"documents": records}, studies=studies, alerts=[unreadable])


def mirror(shaped: DataFrame) -> DataFrame:
    cells = F.array(
        F.struct(F.lit("text").alias("column"), F.lit(None).cast("string").alias("label"), F.col("text").alias("value"))
    )
    return shaped.filter("reason IS NULL").select(
        "period", F.lit(SOURCE).alias("source"), "source_file", "row_number", cells.alias("cells")
    )
