"""Taxonomy classification of feedback items."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keywords import any_hit, best_area, hit_areas, keyword_hits, no_hits
from ..functions.scalars import none_if_empty, strip, text_or_empty


@dataclass(frozen=True)
class Taxonomy:
    """Ordered areas with their keywords, and exact category maps."""

    areas: list[tuple[str, list[str]]]
    source_map: dict[str, dict[str, tuple[str, str | None]]] = field(default_factory=dict)
    version: str | None = None
    content_hash: str | None = None
    labels: dict[str, str] = field(default_factory=dict)


def _mapped(taxonomy: Taxonomy, map_name: Column, key: Column) -> Column:
    """Struct (area, theme) of an exact category, null when there is none.

    The maps are hand-written dimensions of the job's own settings (tens of
    entries), so they are part of the expression and no join is needed.
    """
    entries = [
        (F.lit(name + "\x1f" + k), F.struct(F.lit(a).alias("area"), F.lit(t).cast("string").alias("theme")))
        for name, keys in taxonomy.source_map.items()
        for k, (a, t) in keys.items()
    ]
    if not entries:
        return F.lit(None).cast("struct<area:string,theme:string>")
    lookup = F.map_from_arrays(F.array(*[k for k, _ in entries]), F.array(*[v for _, v in entries]))
    return F.try_element_at(lookup, F.concat(map_name, F.lit("\x1f"), strip(key)))


def classify(
    df: DataFrame,
    taxonomy: Taxonomy,
    text: Column,
    theme: Column,
    context: Column,
    map_name: Column | None = None,
    map_key: Column | None = None,
) -> DataFrame:
    """Add area, areas, theme and theme_method.

    Precedence: exact source category, the source's own theme label, the text, the
    question (only when there is a text), else "other". Every text is scanned once;
    theme and question are scanned only where they can decide.
    """
    areas = taxonomy.areas
    none = no_hits(areas)
    mapped = _mapped(taxonomy, map_name, map_key) if map_name is not None else F.lit(None).cast("struct<area:string,theme:string>")
    scanned = df.withColumns(
        {
            "_text_hits": F.when(text_or_empty(text) != "", keyword_hits(text, areas)).otherwise(none),
            "_theme_hits": F.when(text_or_empty(theme) != "", keyword_hits(theme, areas)).otherwise(none),
            "_mapped": mapped,
            "_label": none_if_empty(theme),
            "_has_text": text_or_empty(text) != "",
        }
    )
    undecided = F.col("_mapped").isNull() & ~any_hit(F.col("_text_hits")) & ~any_hit(F.col("_theme_hits"))
    scanned = scanned.withColumn(
        "_context_hits",
        F.when(undecided & F.col("_has_text") & (text_or_empty(context) != ""), keyword_hits(context, areas)).otherwise(none),
    )
    by_theme, by_text, by_context = any_hit(F.col("_theme_hits")), any_hit(F.col("_text_hits")), any_hit(F.col("_context_hits"))
    is_mapped = F.col("_mapped").isNotNull()
    both = F.zip_with("_text_hits", "_theme_hits", lambda a, b: a + b)
    found = hit_areas(both, areas)
    results = {
            "area": F.when(is_mapped, F.col("_mapped.area"))
            .when(by_theme, best_area(F.col("_theme_hits"), areas))
            .when(by_text, best_area(F.col("_text_hits"), areas))
            .when(by_context, best_area(F.col("_context_hits"), areas))
            .otherwise("other"),
            "areas": F.when(is_mapped, F.array_sort(F.array_union(found, F.array(F.col("_mapped.area")))))
            .when(by_theme | by_text, found)
            .otherwise(hit_areas(F.col("_context_hits"), areas)),
            "theme": F.when(is_mapped, F.col("_mapped.theme")).otherwise(F.col("_label")),
            "theme_method": F.when(is_mapped, "source_map")
            .when(by_theme, "source_theme")
            .when(by_text, "text_rule")
            .when(by_context, "question_rule")
            .otherwise("none"),
    }
    # through a generator, below which no filter on the results is pushed: one scan of each text
    once = F.inline(F.array(F.struct(*[value.alias(f"_{name}") for name, value in results.items()])))
    spare = ["_text_hits", "_theme_hits", "_context_hits", "_label", "_has_text"]
    kept = [c for c in scanned.columns if c not in (*spare, "_mapped", *results)]
    made = scanned.select(*kept, once)
    return made.withColumnsRenamed({f"_{name}": name for name in results})
