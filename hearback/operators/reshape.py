"""Header binding and wide-to-long reshaping.

What depends only on a header is worked out once for each distinct header ("layout", tiny)
and joined to the rows of all files that have it; a row then reads its cells by position. Long rows come
from exploding the row itself, so reshaping needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import strip, text_or_empty

# Panel header shape: section, quoted question, field.
PANEL_HEADER = (
    r'(?s)^(?<section>\d+(?:\.\d+)?\.?\s*\([^)]*\)|\([^)]*\))?\s*'
    r'(?:\((?<label>[^:()]+):\s*"(?<question>.*?)"\))?\s*(?<field>.*)$'
)


def position_of(header: Column, name: str) -> Column:
    """0-based position of a column; the last one wins when a header repeats."""
    from_end = F.array_position(F.reverse(header), F.lit(name)).cast("int")
    return F.when(from_end > 0, F.size(header) - from_end)


def cell_at(cells: Column, position: Column) -> Column:
    """Cell at a 0-based position; '' when the column or the cell is missing."""
    return F.coalesce(F.get(cells, F.coalesce(position, F.lit(-1))), F.lit(""))


def pad(cells: Column, width: Column) -> Column:
    """Short records are filled up with empty cells."""
    missing = F.greatest(width - F.size(cells), F.lit(0))
    return F.when(missing > 0, F.concat(cells, F.array_repeat(F.lit(""), missing))).otherwise(cells)


def header_parts(header: Column) -> Column:
    """Struct (section, question, field) of a panel-test column header."""

    def group(i: int) -> Column:
        return strip(F.regexp_extract(header, PANEL_HEADER, i))

    return F.struct(group(1).alias("section"), group(3).alias("question"), group(4).alias("field"))


def wide_to_long(df: DataFrame, keep: list[str], measures: dict[str, Column], name: str, value: str) -> DataFrame:
    """One row per non-empty measure of each row."""
    entries = F.array(*[F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in measures.items()])
    filled = F.filter(entries, lambda e: e[value].isNotNull())
    return df.select(*keep, F.explode(filled).alias("_m")).select(*keep, f"_m.{name}", f"_m.{value}")


def residual(names: Column, cells: Column, drop: list[str], repeats: Column | None = None) -> Column:
    """(key, value) entries of the columns nobody curated, empty cells left out.

    ``repeats`` says that a name may occur twice in this file; the last filled cell
    wins then. It is known per file, so other files pay nothing for it.
    """
    entries = F.transform(names, lambda k, i: F.struct(k.alias("key"), F.get(cells, i).alias("value")))
    filled = F.filter(
        entries,
        lambda e: e["key"].isNotNull() & (text_or_empty(e["value"]) != "") & ~e["key"].isin(drop),
    )
    if repeats is None:
        return filled

    def is_last(e: Column, i: Column) -> Column:
        later = F.slice(filled, i + 2, F.greatest(F.size(filled) - i - 1, F.lit(0)))
        return ~F.exists(later, lambda other: other["key"] == e["key"])

    return F.when(repeats, F.filter(filled, is_last)).otherwise(filled)


def question_layout(headers: DataFrame, key: str = "header_key") -> DataFrame:
    """Per header of a survey an array of questions with the positions of their cells."""
    columns = (
        headers.select(key, "labels", F.posexplode("header").alias("pos", "name"))
        .withColumn("no", F.regexp_extract("name", r"(?s)^Q(\d+)_(.+)$", 1))
        .filter("no <> ''")
        .withColumn("kind", F.regexp_extract("name", r"(?s)^Q(\d+)_(.+)$", 2))
        .withColumn("label", F.coalesce(F.get("labels", F.col("pos")), F.lit("")))
        .withColumn("no", F.col("no").cast("int"))
    )

    def place(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col("pos")))

    def many(pattern: str) -> Column:
        cell = F.struct(F.col("pos"), F.col("label"))
        return F.array_sort(F.collect_list(F.when(F.col("kind").rlike(pattern), cell)))

    question = columns.groupBy(key, "no").agg(
        place("Question_Text").alias("text"),
        F.max(F.when(F.col("kind") == "Question_Text", F.struct("pos", "label")))["label"].alias("label"),
        place("Response").alias("response"),
        place("Value").alias("value"),
        place("Response_Other").alias("other"),
        place("Response_NPSCategory").alias("nps"),
        place("Theme").alias("theme"),
        many(r"^Theme_\d+$").alias("themes"),
        many(r"^Choice_\d+$").alias("choices"),
    )
    return question.groupBy(key).agg(
        F.array_sort(
            F.collect_list(
                F.struct("no", "text", "label", "response", "value", "other", "nps", "theme", "themes", "choices")
            )
        ).alias("questions")
    )


# Cells of multi-select columns that mean "not chosen" / "chosen".
UNCHECKED = ["", "0", "false", "False"]
CHECKED = ["1", "true", "True"]


def chosen_labels(cells: Column, options: Column) -> Column:
    """Labels of all columns with any mark in them."""
    marked = F.filter(options, lambda o: ~cell_at(cells, o["pos"]).isin(UNCHECKED))
    return F.transform(marked, lambda o: o["label"])


def chosen_values(cells: Column, options: Column) -> Column:
    """Label of a ticked column, else what was written into the cell."""
    marked = F.filter(options, lambda o: ~cell_at(cells, o["pos"]).isin(UNCHECKED))
    return F.transform(
        marked,
        lambda o: F.when(cell_at(cells, o["pos"]).isin(CHECKED) & (o["label"] != ""), o["label"]).otherwise(
            cell_at(cells, o["pos"])
        ),
    )


def match_headers(columns: DataFrame, patterns: list[tuple[str, str]], key: str = "source_file") -> DataFrame:
    """Bind headers to fields by ordered patterns: per file ``fields`` (field → position)
    and ``unmapped`` headers.

    A column takes the first pattern that matches and whose field no earlier column
    holds. That is decided column by column from left to right, as a fold over the
    file's own header with the taken fields as state.
    """
    rules = F.array(*[F.struct(F.lit(rx).alias("rx"), F.lit(f).alias("field")) for rx, f in patterns])
    empty = F.struct(
        F.array().cast("array<struct<key:string,value:int>>").alias("fields"),
        F.array().cast("array<string>").alias("unmapped"),
    )

    def take(acc: Column, c: Column) -> Column:
        taken = F.transform(acc["fields"], lambda f: f["key"])
        free = F.filter(rules, lambda r: F.rlike(c["name"], r["rx"]) & ~F.array_contains(taken, r["field"]))
        field = F.get(free, F.lit(0))["field"]
        return F.struct(
            F.when(
                field.isNotNull(), F.concat(acc["fields"], F.array(F.struct(field.alias("key"), c["pos"].alias("value"))))
            ).otherwise(acc["fields"]).alias("fields"),
            F.when(field.isNull(), F.concat(acc["unmapped"], F.array(c["name"])))
            .otherwise(acc["unmapped"])
            .alias("unmapped"),
        )

    placed = F.transform("header", lambda n, i: F.struct(n.alias("name"), i.alias("pos")))
    return columns.select(key, F.aggregate(placed, empty, take).alias("m")).select(
        key, F.map_from_entries("m.fields").alias("fields"), F.col("m.unmapped").alias("unmapped")
    )
