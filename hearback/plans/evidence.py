"""The evidence fact: one row per piece of feedback, from any source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import answer_type, none_if_empty, short_hash, text_or_empty
from ..operators.classify import Taxonomy, classify
from ..schemas import EVIDENCE

# What a family hands over; anything it leaves out is null.
INPUT_TYPES = {
    "source": "string", "record_id": "string", "sub_id": "string", "period": "string",
    "occurred_at": "timestamp_ntz", "population": "string", "user_key": "string", "user_id": "string",
    "instrument": "string", "question": "string", "text": "string", "category": "string",
    "score": "double", "score_type": "string", "source_theme": "string", "map_name": "string",
    "map_key": "string", "segment": "string", "audience": "string", "channel": "string",
    "plan": "string", "initiative": "string", "source_file": "string", "row_number": "long",
    "is_choice": "boolean", "seq": "long",
}


def feedback(df: DataFrame, carry: tuple[str, ...] = (), **values: Column) -> DataFrame:
    """Project a family's records onto the common feedback columns."""
    unknown = set(values) - set(INPUT_TYPES)
    if unknown:
        raise ValueError(f"unknown feedback columns: {sorted(unknown)}")
    defaults = {"population": F.lit("user"), "is_choice": F.lit(False)}
    picked = [
        values.get(name, defaults.get(name, F.lit(None))).cast(kind).alias(name) for name, kind in INPUT_TYPES.items()
    ]
    return df.select(*picked, *carry)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def build_evidence(items: DataFrame, taxonomy: Taxonomy, carry: tuple[str, ...] = ()) -> DataFrame:
    """Classify feedback items and add the derived columns."""
    blob = F.concat_ws(" ", none_if_empty("text"), none_if_empty("category"))
    tagged = classify(
        items.withColumn("_blob", blob),
        taxonomy,
        text=F.col("_blob"),
        theme=F.col("source_theme"),
        context=F.col("question"),
        map_name=F.col("map_name"),
        map_key=F.col("map_key"),
    )
    option = F.when(F.col("is_choice") & (text_or_empty("text") != ""), F.left("text", F.lit(120)))
    derived = tagged.withColumns(
        {
            "evidence_id": F.concat(F.lit("ev_"), short_hash("source", "record_id", "sub_id")),
            "sub_id": none_if_empty("sub_id"),
            "user_id": none_if_empty("user_id"),
            "source_theme": none_if_empty("source_theme"),
            "text_chars": F.char_length(text_or_empty("text")),
            "theme": F.coalesce("theme", option),
            "answer_type": answer_type(F.col("is_choice"), F.col("score_type"), F.col("text")),
        }
    )
    return derived.select(*[f.name for f in EVIDENCE.fields], *carry)
