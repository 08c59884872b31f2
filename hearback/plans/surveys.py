"""Survey exports: two header rows (names, labels), questions in groups of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    audience_code,
    initiative_of,
    is_digits,
    none_if_empty,
    parse_dt,
    slug,
    sorted_json,
    squash_spaces,
    strip,
    text_or_empty,
    to_float,
)
from ..operators.names import name_tokens
from ..operators.reshape import cell_at, chosen_labels, chosen_values, pad, question_layout, residual
from .evidence import feedback
from .family import KEY, SEQ, Columns, Output, Run, bind, file_name, file_stem, loaded, shape, surrogate_id, unparsed_dates

SOURCE = "sprig"

# Column names and attribute labels of the export.
COLUMNS = [
    "surveyId", "surveyName", "visitorId", "href", "os", "browser", "triggeringEvent", "userId",
    "responseGroupUid", "createdAt", "completedAt",
]
ATTRIBUTES = [
    "email", "firstName", "lastName", "isStaff", "audienceCategory", "audience", "subscriberStatus", "status",
    "planId", "planType", "tenure", "gradeLevel", "deviceType", "appVersion", "sdkVersion",
]
PERSONAL = ["email", "firstName", "lastName"]
KEYS = ["surveyId", "visitorId", "userId", "responseGroupUid", "createdAt", "completedAt"]
SKIPPED = "[skipped by user]"

COLS = Columns(*COLUMNS)


def actions() -> Column:
    """Mask per column. Contact data is masked in every cell that is not a key."""
    label = F.col("attribute_labels")
    return F.transform(
        "header",
        lambda c, i: F.when(F.get(label, i) == "email", "email")
        .when(F.get(label, i).isin("firstName", "lastName"), "name")
        .when(c.rlike(r"^Q\d+_Response(?:_Other)?$"), "text")
        .when(c.isin(KEYS), "")
        .when(F.get(label, i).isNotNull(), "value")
        .otherwise("contact"),
    )


def layout(heads: DataFrame) -> DataFrame:
    usable = heads.filter("header_rows = 2").withColumn("labels", pad(F.col("labels"), F.size("header")))
    attribute = F.transform(
        "header", lambda c, i: F.when(c.startswith("Attribute_"), F.get(F.col("labels"), i))
    )
    labelled = F.array_compact("attribute_labels")
    placed = usable.withColumn("attribute_labels", attribute)

    def attribute_positions(name: str) -> Column:
        places = F.transform("attribute_labels", lambda label, i: F.when(label == name, i))
        return F.reverse(F.array_compact(places))

    bound = placed.select(
        KEY,
        "header",
        "labels",
        "header_rows",
        actions().alias("actions"),
        COLS.positions(F.col("header")).alias("pos"),
        "attribute_labels",
        (F.size(F.array_distinct(labelled)) < F.size(labelled)).alias("labels_repeat"),
        F.array(*[attribute_positions(a) for a in ATTRIBUTES]).alias("attribute_pos"),
    )
    return bound.join(question_layout(usable, KEY), KEY, "left")


def attribute(name: str, cells: str = "masked") -> Column:
    """The last filled cell of all columns with this label."""
    places = F.get(F.col("attribute_pos"), F.lit(ATTRIBUTES.index(name)))
    last = cell_at(F.col(cells), F.get(places, F.lit(0)))
    filled = F.filter(F.transform(places, lambda p: cell_at(F.col(cells), p)), lambda v: v != "")
    return F.when(F.size(places) < 2, last).otherwise(F.coalesce(F.get(filled, F.lit(0)), F.lit("")))


def either(*cells: Column) -> Column:
    return F.coalesce(*[none_if_empty(c) for c in cells])


def people(run: Run) -> DataFrame:
    rows = bind(run, SOURCE, layout(run.layouts(SOURCE)))
    return rows.select(name_tokens(attribute("firstName", "cells"), attribute("lastName", "cells")).alias("tokens"))


def family(name: Column, rules: list[tuple[str, str]]) -> Column:
    path = F.lower(F.concat(F.lit("/"), F.col("source_file")))
    low = F.lower(name)
    return (
        F.when(F.contains(path, F.lit("/nps/")) | F.contains(low, F.lit("nps")), "NPS")
        .when(F.contains(path, F.lit("/pmf/")) | low.startswith("pmf"), "PMF")
        .otherwise(F.coalesce(initiative_of(name, file_name(), rules=rules), F.lit("Other")))
    )


def responses(shaped: DataFrame, run: Run, *carry: str) -> DataFrame:
    name = COLS.raw("surveyName")
    audience = audience_code(either(attribute("audienceCategory"), attribute("audience")))
    from_file = F.when(F.contains(F.lower(file_name()), F.lit("non-bcm")), "Non-BCM").when(
        F.contains(F.lower(file_name()), F.lit("bcm")), "BCM"
    )
    from_audience = F.when(audience == "book_club_member", "BCM").when(audience.isNotNull(), "Non-BCM")
    uid = strip(COLS.raw("userId"))
    return loaded(shaped).select(
        F.col("record_id").alias("response_id"),
        "period",
        none_if_empty(COLS.raw("surveyId")).alias("survey_id"),
        none_if_empty(name).alias("survey_name"),
        family(name, run.settings.initiatives).alias("survey_family"),
        initiative_of(name, file_name(), rules=run.settings.initiatives).alias("initiative"),
        parse_dt(COLS.raw("createdAt")).alias("created_at"),
        parse_dt(COLS.raw("completedAt")).alias("completed_at"),
        "user_key",
        F.when(is_digits(uid), uid).alias("user_id"),
        none_if_empty(COLS.raw("visitorId")).alias("visitor_id"),
        F.coalesce(from_file, from_audience).alias("segment"),
        audience.alias("audience"),
        either(attribute("subscriberStatus"), attribute("status")).alias("subscriber_status"),
        either(attribute("planId"), attribute("planType")).alias("plan"),
        none_if_empty(attribute("tenure")).alias("tenure"),
        none_if_empty(attribute("gradeLevel")).alias("grade_level"),
        F.when((attribute("appVersion") != "") | (attribute("sdkVersion") != ""), "app").otherwise("web").alias("channel"),
        none_if_empty(COLS.masked("os")).alias("os"),
        none_if_empty(COLS.masked("browser")).alias("browser"),
        none_if_empty(attribute("deviceType")).alias("device_type"),
        none_if_empty(COLS.masked("href")).alias("href"),
        none_if_empty(COLS.masked("triggeringEvent")).alias("triggering_event"),
        sorted_json(residual(F.col("attribute_labels"), F.col("masked"), PERSONAL, F.col("labels_repeat"))).alias("attributes"),
        "source_file",
        "row_number",
        SEQ,
        *carry,
    )


def answers(responded: DataFrame) -> DataFrame:
    """One row per response and answered question, cells read by position.

    Needs no shuffle: the questions of the file's header are exploded on each row.
    """
    q = F.col("q")
    cells = F.col("masked")
    asked = responded.select("*", F.explode("questions").alias("q")).drop("questions")
    primary = cell_at(cells, q["theme"])
    parts = asked.withColumns(
        {
            "question": none_if_empty(
                squash_spaces(F.coalesce(none_if_empty(cell_at(cells, q["text"])), q["label"], F.lit("")))
            ),
            "response": cell_at(cells, q["response"]),
            "response_other": cell_at(cells, q["other"]),
            "value": to_float(cell_at(cells, q["value"])),
            "nps_category": none_if_empty(cell_at(cells, q["nps"])),
            "primary_theme": none_if_empty(primary),
            "themes": chosen_labels(cells, q["themes"]),
            "choices": chosen_values(cells, q["choices"]),
            "is_nps": q["nps"].isNotNull(),
            "is_choice": (F.size(q["choices"]) > 0) | (q["value"].isNotNull() & q["nps"].isNull()),
            "question_no": q["no"],
        }
    ).drop("q", "masked")
    marked = (F.size("themes") > 0) | (F.size("choices") > 0)
    answered = parts.filter((F.col("response") != "") | (F.col("response_other") != "") | marked)
    skipped = F.lower(strip("response")) == SKIPPED
    typed = answered.withColumn("skipped", skipped).withColumn(
        "response", F.when(~F.col("skipped"), none_if_empty("response"))
    )
    return score(typed.withColumn("response_other", none_if_empty("response_other")))


def score(answered: DataFrame) -> DataFrame:
    """Add score, score_type and category by the kind of question."""
    number = to_float("response")
    question = F.lower(text_or_empty("question"))
    is_pmf = (F.col("survey_family") == "PMF") & (
        F.contains(question, F.lit("no longer use")) | F.contains(question, F.lit("feel if"))
    )
    marked = (F.size("themes") > 0) | (F.size("choices") > 0)
    kind = (
        F.when(F.col("is_nps"), "nps_0_10")
        .when(is_pmf, "pmf_1_5")
        .when(F.col("value").isNotNull(), "choice_value")
        .when(number.isNotNull() & ~marked, "scale")
    )
    whole = number.try_cast("int")
    pmf_category = (
        F.when(
            number.isNotNull(),
            F.when(whole == 5, "very_disappointed").when(whole == 4, "somewhat_disappointed").otherwise("not_disappointed"),
        )
        .when(F.contains(F.lower("response"), F.lit("very")), "very_disappointed")
        .otherwise(F.col("response"))
    )
    typed = answered.withColumns({"score_type": kind, "_number": number})
    return typed.withColumns(
        {
            "score": F.when(F.col("score_type") == "choice_value", F.col("value")).when(
                F.col("score_type").isNotNull(), F.col("_number")
            ),
            "category": F.when(F.col("score_type") == "nps_0_10", F.col("nps_category")).when(
                F.col("score_type") == "pmf_1_5", pmf_category
            ),
        }
    ).drop("_number")


def answer_items(answered: DataFrame) -> DataFrame:
    """Feedback of all answers but those that were only skipped."""
    other = F.col("response_other")
    written = F.concat_ws(" | ", "response", F.when(F.col("response").isNotNull(), F.concat(F.lit("Other: "), other)).otherwise(other))
    text = F.coalesce(none_if_empty(written), none_if_empty(F.array_join("choices", "; ")))
    marked = (F.size("themes") > 0) | (F.size("choices") > 0)
    said = answered.filter(~F.col("skipped") | other.isNotNull() | marked)
    themes = F.concat_ws("; ", F.col("primary_theme"), F.col("themes"))
    return feedback(
        said,
        source=F.lit(SOURCE),
        record_id=F.col("response_id"),
        sub_id=F.col("question_no"),
        period=F.col("period"),
        occurred_at=F.col("created_at"),
        user_key=F.col("user_key"),
        user_id=F.col("user_id"),
        instrument=F.coalesce(F.col("survey_name"), file_stem()),
        question=F.col("question"),
        text=text,
        category=F.col("category"),
        score=F.col("score"),
        score_type=F.col("score_type"),
        source_theme=themes,
        segment=F.col("segment"),
        audience=F.col("audience"),
        channel=F.col("channel"),
        plan=F.col("plan"),
        initiative=F.col("initiative"),
        source_file=F.col("source_file"),
        row_number=F.col("row_number"),
        seq=F.col(SEQ),
        is_choice=F.col("is_choice"),
    )


ANSWER_COLUMNS = [
    "response_id", "question_no", "question", "skipped", "response", "response_other", "value", "nps_category",
    "primary_theme", "themes", "choices",
]


def shaped_records(run: Run) -> DataFrame:
    staff = F.lower(strip(attribute("isStaff", "cells"))) == "true"
    return shape(
        run,
        SOURCE,
        layout(run.layouts(SOURCE)),
        email=attribute("email", "cells"),
        own_names=F.array(attribute("firstName", "cells"), attribute("lastName", "cells")),
        record_id=F.coalesce(none_if_empty(COLS.raw("responseGroupUid")), surrogate_id("sp_")),
        rules=[("staff_response", staff)] if run.settings.exclude_staff else [],
    )


def build(run: Run) -> Output:
    shaped = shaped_records(run)
    responded = responses(shaped, run, "masked", "questions")
    answered = run.work.stage(answers(responded), "survey_answers")
    records = responded.drop("masked", "questions")
    studies = (
        records.groupBy("survey_id", "survey_name", "survey_family", "initiative", "period", "source_file")
        .agg(F.count("*").alias("n"))
        .select(
            F.concat(F.lit("sprig_"), F.coalesce("survey_id", F.lit("None")), F.lit("_"), F.col("period")).alias("study_id"),
            F.concat(F.lit("sprig_"), slug("survey_family")).alias("kind"),
            F.col("survey_name").alias("name"),
            "initiative",
            "period",
            "n",
            "source_file",
        )
    )
    created = COLS.raw("createdAt")
    return Output(
        shaped,
        {"sprig_responses": records, "sprig_answers": answered.select(*ANSWER_COLUMNS)},
        answer_items(answered),
        studies,
        [unparsed_dates(shaped, SOURCE, created, parse_dt(created))],
    )
