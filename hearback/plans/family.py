"""What all export families share: binding cells to columns, masking, keep-first, rejects."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import masks
from ..functions.scalars import hash_id, is_blank, is_digits, short_hash, strip, user_key
from ..operators.names import capital_pairs, known_names
from ..operators.records import mark_repeats, reject_reason
from ..operators.reshape import cell_at, pad, position_of
from ..operators.skew import HOT_ROWS, spread_join
from ..session import Inline, Workspace
from ..settings import Settings

# Names a distinct header; rows and layouts carry it.
KEY = "header_key"

# A record's place in processing order, as one number: file (28 bits), then row (35 bits).
SEQ = "seq"
ROW_BITS, FILE_BITS = 35, 28


def sequence(file_no: Column | str = "file_no", row_number: Column | str = "row_number") -> Column:
    """The place as one number; a file or row beyond its bits fails the run."""
    file_no, row_number = (F.col(c) if isinstance(c, str) else c for c in (file_no, row_number))
    fits = (file_no >= 0) & (file_no < 1 << FILE_BITS) & (row_number >= 0) & (row_number < 1 << ROW_BITS)
    error = F.raise_error(F.lit("more files or rows than a processing order holds")).cast("long")
    return F.when(fits, F.shiftleft(file_no, ROW_BITS) + row_number).otherwise(error)


@dataclass
class Run:
    """Everything a family needs to turn its records into tables."""

    settings: Settings
    work: Workspace
    raw: DataFrame
    headers: DataFrame
    registry: DataFrame | None = None
    hot_rows: int = HOT_ROWS

    registry_rows: int | None = None
    layouts_small: bool = True

    @property
    def inline(self) -> bool:
        return isinstance(self.work, Inline)

    def rows(self, source: str) -> DataFrame:
        rows = self.raw.filter((F.col("source") == source) & (F.col("row_number") > 0))
        return rows.withColumn(SEQ, sequence()).drop("source", "file_no")

    def heads(self, source: str) -> DataFrame:
        return self.headers.filter(F.col("source") == source).drop("source")

    def layouts(self, source: str) -> DataFrame:
        """The distinct headers of a family: as many as there are shapes of its export, not as files."""
        return self.heads(source).select(KEY, "header", "labels", "header_rows").dropDuplicates([KEY])


@dataclass
class Output:
    """Tables of one family, its feedback items, its judged records and alerts."""

    shaped: DataFrame
    tables: dict[str, DataFrame]
    items: DataFrame | None = None
    studies: DataFrame | None = None
    alerts: list[DataFrame] | None = None


class Columns:
    """Named columns of a family, read by position through the layout of the file."""

    def __init__(self, *names: str):
        self.index = {n: i for i, n in enumerate(names)}

    def positions(self, header: Column) -> Column:
        return F.array(*[position_of(header, n) for n in self.index])

    def _at(self, cells: str, name: str) -> Column:
        return cell_at(F.col(cells), F.get(F.col("pos"), F.lit(self.index[name])))

    def raw(self, name: str) -> Column:
        return self._at("cells", name)

    def masked(self, name: str) -> Column:
        return self._at("masked", name)


def unshadowed(header: Column) -> Column:
    """Header with null for names a later column repeats."""
    size = F.size(header)
    return F.transform(header, lambda n, i: F.when(F.array_position(F.reverse(header), n) == size - i, n))


def file_name(path: str = "source_file") -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: str = "source_file") -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def surrogate_id(prefix: str) -> Column:
    return F.concat(F.lit(prefix), short_hash("source_file", "row_number"))


def with_layout(run: Run, rows: DataFrame, layout: DataFrame) -> DataFrame:
    """Rows with the layout of their file's header. There is one layout for each distinct header; they are
    broadcast where they were measured to be small; a header of many rows is spread over salts otherwise.

    A layout is wider than many a record, so it is joined where it is used and does
    not travel through shuffles or into the work folder.
    """
    if run.layouts_small:
        return rows.join(F.broadcast(layout), KEY)
    return spread_join(rows, layout, [KEY], "inner", spread_by=[SEQ], hot_rows=run.hot_rows)


def bind(run: Run, source: str, layout: DataFrame) -> DataFrame:
    """Rows of a family with the layout of their file, short records filled up."""
    bound = with_layout(run, run.rows(source), layout)
    return bound.withColumn("cells", pad(F.col("cells"), F.size("header")))


FREE_TEXT = ["text", "mail", "subject"]


def add_known_names(df: DataFrame, bound: DataFrame, run: Run, source: str) -> DataFrame:
    """Add the known names found in the text cells of each row."""
    if run.registry is None:
        none = F.array().cast("array<string>")
        return df.withColumns({"known_pairs": none, "known_firsts": none})
    texts = F.filter(F.col("cells"), lambda c, i: F.get(F.col("actions"), i).isin(FREE_TEXT))
    known = known_names(
        bound.select(SEQ, F.flatten(F.transform(texts, capital_pairs)).alias("_pairs")),
        [SEQ],
        F.col("_pairs"),
        run.registry,
        run.registry_rows,
        stage=lambda found: run.work.stage(found, f"pairs/{source}"),
        hot_rows=run.hot_rows,
    )
    return df.join(run.work.settle(known, f"known/{source}"), SEQ, "left")


def mask_cells(df: DataFrame, run: Run, mail: bool) -> DataFrame:
    """Add ``masked``: every cell after the mask its column calls for (``actions``).

    Expects ``own_names``, ``known_pairs``, ``known_firsts``, ``user_key`` and, for
    mail senders, ``sender`` on the row. Each step is one projection, so that no
    step's expression is repeated inside the next.
    """
    stop = run.settings.stop_words
    action = F.col("actions")

    def first_step(c: Column, i: Column) -> Column:
        a = F.coalesce(F.get(action, i), F.lit("contact"))  # a cell beyond the header
        return (
            F.when((c == "") | (a == ""), c)
            .when(a.isin(FREE_TEXT), masks.scrub(c, F.col("own_names"), F.col("known_pairs"), stop))
            .when(a == "email", F.coalesce(F.col("user_key"), F.lit("[email]")))
            .when(a == "name", F.lit(masks.MASK))
            .when(a == "id", F.coalesce(hash_id(c, run.settings.salt), F.lit("")))
            .when(a == "removed", F.lit("[removed]"))
            .when(a == "contact", masks.mask_contacts(c))
            .when(a == "value", F.when(is_digits(c), c).otherwise(masks.mask_contacts(c)))
            .when(a == "sender", F.col("sender") if mail and "sender" in df.columns else c)
            .otherwise(c)
        )

    df = df.withColumn("masked", F.transform("cells", first_step))
    if mail:
        mail_like = ["mail", "subject"]

        def on_mail(step: Callable[[Column], Column]) -> Column:
            return F.transform("masked", lambda c, i: F.when(F.get(action, i).isin(mail_like), step(c)).otherwise(c))

        df = df.withColumn("masked", on_mail(lambda c: masks.mask_mail_names(c, F.col("known_firsts"), stop)))
        df = df.withColumn("masked", on_mail(lambda c: masks.mask_same_line_sign_off(c, stop)))
        df = df.withColumn("masked", on_mail(lambda c: masks.mask_signature(c, stop)))
        df = df.withColumn(
            "masked",
            F.transform(
                "masked", lambda c, i: F.when(F.get(action, i) == "subject", masks.mask_subject_name(c)).otherwise(c)
            ),
        )
    return df.drop("known_pairs", "known_firsts", "own_names")


def shape(
    run: Run,
    source: str,
    layout: DataFrame,
    email: Column,
    own_names: Column,
    record_id: Column,
    rules: list[tuple[str, Column]] | None = None,
    extra: dict[str, Column] | None = None,
    mail: bool = False,
    keep_first: bool = True,
) -> DataFrame:
    """Bound, masked and judged records of a family, written once to the work folder.

    All published tables of the family, its rejects and the mirror read this table.
    """
    layout = run.work.stage(layout, f"layout/{source}")
    bound = bind(run, source, layout)
    bound = bound.withColumn("user_key", user_key(email, run.settings.salt))
    if extra:
        bound = bound.withColumns(extra)
    bound = bound.withColumns(
        {"own_names": masks.name_list(own_names), "record_id": record_id, "is_blank": is_blank("cells")}
    )
    for name, test in rules or []:
        bound = bound.withColumn(f"_{name}", test)
    df = bound.drop(*[c for c in layout.columns if c not in (KEY, *(extra or {}))])
    if keep_first:
        df = mark_repeats(
            df,
            ["record_id"],
            SEQ,
            counts=~F.col("is_blank"),
            settle=None if run.inline else lambda found: run.work.settle(found, f"repeats/{source}"),
        )
    else:
        df = df.withColumn("is_repeat", F.lit(False))
    df = add_known_names(df, bound, run, source)
    df = mask_cells(with_layout(run, df, layout), run, mail)
    tests = [(name, F.col(f"_{name}")) for name, _ in rules or []]
    reason = reject_reason(("empty_row", F.col("is_blank")), ("duplicate", F.col("is_repeat")), *tests)
    dropped = [c for c in layout.columns if c != KEY] + [f"_{name}" for name, _ in rules or []]
    judged = df.withColumn("reason", reason).drop(*dropped, "is_blank", "is_repeat")
    return with_layout(run, run.work.stage(judged, f"shaped/{source}"), layout)


def loaded(shaped: DataFrame) -> DataFrame:
    return shaped.filter("reason IS NULL")


def rejects(shaped: DataFrame, source: str) -> DataFrame:
    return shaped.filter("reason IS NOT NULL").select(
        F.lit(source).alias("source"),
        "period",
        "source_file",
        "row_number",
        "record_id",
        F.col("reason").alias("excluded_reason"),
    )


def mirror(shaped: DataFrame, source: str) -> DataFrame:
    """Masked copy of every record: ordered cells with column name and label row. Cells
    beyond the header have no column name."""
    label = F.when(F.col("header_rows") > 1, F.col("labels"))
    cells = F.transform(
        "masked",
        lambda v, i: F.struct(F.get("header", i).alias("column"), F.get(label, i).alias("label"), v.alias("value")),
    )
    return shaped.select("period", F.lit(source).alias("source"), "source_file", "row_number", cells.alias("cells"))


def unparsed_dates(shaped: DataFrame, source: str, value: Column, parsed: Column) -> DataFrame:
    """One alert row per file with dates that fit no known shape."""
    bad = loaded(shaped).filter((strip(value) != "") & parsed.isNull())
    return bad.groupBy("source_file").agg(F.count("*").alias("n")).select(
        F.format_string(f"{source}: %d unparsed dates in %s", F.col("n"), file_name()).alias("alert")
    )
