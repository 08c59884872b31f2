"""Scalar column expressions: text clean-up, keys, dates, numbers, JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace removed by a full trim, and the regex class for it.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = r"[\s\x1c-\x1f\x85\p{Z}]"

# The address shape shared by keys, masks and the leak check.
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"

# Separator between hashed parts, month names in exports.
HASH_SEPARATOR = "\x1f"
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def none_if_empty(c: Column | str) -> Column:
    c = col(c)
    return F.when(c != "", c)


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WHITESPACE))


def squash_spaces(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), SPACE_CLASS + "+", " "))


def is_blank(cells: Column | str) -> Column:
    """True when no cell of the record holds anything but whitespace."""
    return ~F.exists(col(cells), lambda v: strip(text_or_empty(v)) != "")


def short_hash(*parts: Column | str, n: int = 12) -> Column:
    joined = F.concat_ws(HASH_SEPARATOR, *[text_or_empty(p).cast("string") for p in parts])
    return F.substring(F.sha2(joined, 256), 1, n)


def norm_email(c: Column | str) -> Column:
    e = F.lower(strip(c))
    return F.when(e.rlike(f"^(?:{EMAIL})$"), e)


def user_key(email: Column | str, salt: str) -> Column:
    e = norm_email(email)
    return F.concat(F.lit("u_"), F.substring(F.sha2(F.concat(F.lit(salt), e), 256), 1, 16))


def hash_id(value: Column | str, salt: str, prefix: str = "h_") -> Column:
    v = none_if_empty(strip(value))
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat(F.lit(salt + "|id|"), v), 256), 1, 16))


def slug(c: Column | str) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def audience_code(c: Column | str) -> Column:
    return none_if_empty(F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_")))


def is_digits(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike(r"^[0-9]+\z"), F.lit(False))


def email_domain(addr: Column | str) -> Column:
    return F.substring_index(F.lower(strip(addr)), "@", -1)


def local_part_tokens(addr: Column | str) -> Column:
    """Name-like pieces (three letters or more) of the part before the @."""
    local = F.substring_index(col(addr), "@", 1)
    return F.regexp_extract_all(local, F.lit(r"[^._\-+0-9]{3,}"), F.lit(0))


def to_float(c: Column | str) -> Column:
    """Number of a cell; thousands commas dropped, anything else is null."""
    v = F.replace(strip(c), F.lit(","), F.lit(""))
    return F.when(v.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"), v.try_cast("double"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# The date shapes of the exports, brought to one order of fields.
_DATE = "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_HM, _HMS = "[0-9]{1,2}:[0-9]{1,2}", "[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"
_ZONED = rf"{_DATE}T{_HMS}(?:\.[0-9]{{1,6}})?(?:[Zz]|[+-][0-9]{{2}}:?[0-9]{{2}})"
_PLAIN = rf"{_DATE}(?: +{_HM}(?::[0-9]{{1,2}})?)?"
_SLASHED = rf"[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}(?: +{_HM}(?::[0-9]{{1,2}})?)?"
_DASHED = "[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}"
_NAMED = rf"[A-Za-z]+ +[0-9]{{1,2}}, +[0-9]{{4}}(?: +{_HM} +[AaPp][Mm])?"


def parse_dt(c: Column | str) -> Column:
    """Timestamp (UTC, no zone) of a cell in any of the date shapes the exports use.

    The shape is decided by regex and the fields are put together from their digits,
    so a value that fits no shape costs no failed parse and no session time zone
    takes part.
    """
    return let(strip(c), lambda v: let(_year_first(v), _stamp))


def _year_first(v: Column) -> Column:
    """Year, month, day, then the time as written; null when no shape fits."""
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(v, "^([A-Za-z]+)", 1)))
    named = F.concat(
        F.regexp_extract(v, ", +([0-9]{4})", 1),
        F.lit("-"),
        month.cast("string"),
        F.regexp_replace(v, "^[A-Za-z]+ +([0-9]{1,2}), +[0-9]{4}", "-$1"),
    )
    return (
        F.when(v.rlike(f"^(?:{_ZONED}|{_PLAIN})$"), v)
        .when(v.rlike(f"^{_SLASHED}$"), F.regexp_replace(v, "^([0-9]+)/([0-9]+)/([0-9]+)", "$3-$1-$2"))
        .when(v.rlike(f"^{_DASHED}$"), F.regexp_replace(v, "^([0-9]+)-([0-9]+)-([0-9]+)$", "$3-$1-$2"))
        .when(v.rlike(f"^{_NAMED}$"), named)
    )


def _stamp(v: Column) -> Column:
    # a cast that fails costs an exception for each row, so times without seconds are not cast
    second = F.regexp_extract(v, r":[0-9]+:([0-9]+(?:\.[0-9]+)?)", 1)
    second = F.when(second != "", second.try_cast("decimal(16,6)"))
    zone = F.regexp_extract(v, r"([+-][0-9]{2}:?[0-9]{2})$", 1)
    shift = F.when(
        F.contains(v, F.lit("T")) & (zone != ""),
        F.concat(F.left(zone, F.lit(1)), F.lit("1")).try_cast("int")
        * (F.substring(zone, 2, 2).try_cast("int") * 60 + F.right(zone, F.lit(2)).try_cast("int")),
    ).otherwise(F.lit(0))

    def build(p: Column) -> Column:
        def at(i: int) -> Column:
            return F.coalesce(F.get(p, F.lit(i)).try_cast("int"), F.lit(0))

        half = F.lower(F.right(v, F.lit(2)))
        hour = F.when(~half.isin("am", "pm"), at(3)).when(
            at(3).between(1, 12), at(3) % 12 + F.when(half == "pm", 12).otherwise(0)
        )
        seconds = F.coalesce(second, F.lit(0).cast("decimal(16,6)"))
        made = F.try_make_timestamp_ntz(at(0), at(1), at(2), hour, at(4), seconds)
        return F.when(seconds < 60, made) - F.make_dt_interval(mins=shift)

    return let(F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0)), build)


def sorted_json(entries: Column | str) -> Column:
    """JSON object of (key, value) entries without repeated keys, keys in order."""
    return F.to_json(F.map_from_entries(F.sort_array(col(entries))))


def json_field(c: Column | str, key: str) -> Column:
    return F.get_json_object(col(c), "$['" + key + "']")


# Initiative patterns in order of precedence.
INITIATIVES = [
    (r"book[\s_]*hub|\bbhb\b|book brief|books? like", "Book Hub"),
    (r"growth[\s_]*exp", "Growth Experimentation"),
    (r"\bpin\b|book clubs?", "PIN / Book Clubs"),
    (r"\bpmf\b", "PMF"),
    (r"\bnps\b", "NPS"),
    (r"funnel", "Funnel Revamp"),
    (r"jtbd|payoff", "Growth Experimentation"),
    (r"\bcx\b|bug analysis|freshdesk", "CX"),
]


def first_rule(blob: Column, rules: list[tuple[str, str]]) -> Column:
    """Name of the first ordered regex found in ``blob``, else null."""
    return F.coalesce(*[F.when(blob.rlike("(?i)" + rx), F.lit(name)) for rx, name in rules])


def initiative_of(*texts: Column | str, rules: list[tuple[str, str]] = INITIATIVES) -> Column:
    return first_rule(F.concat_ws(" ", *[text_or_empty(t) for t in texts]), rules)


def answer_type(is_choice: Column, score_type: Column, text: Column) -> Column:
    only_digits = text_or_empty(text).rlike(r"^[ 0-9.]*\z")
    return (
        F.when(is_choice, "choice").when(score_type.isNotNull() & only_digits, "score").otherwise("text")
    )


def small_sample(n: Column | str, limit: int = 30) -> Column:
    """Figures on fewer than ``limit`` answers are directional only."""
    return col(n) < limit
