"""Masking expressions. All work on one text column; what has to be looked up
(names seen elsewhere) arrives as arrays on the same row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import EMAIL, WHITESPACE, col, let, strip

MASK = "[name]"

# Patterns of personal data in free text.
PHONE = (
    r"(?<!\p{Nd})(?:\+?1[\s\p{Z}.\-]?)?(?:\(\p{Nd}{3}\)|\p{Nd}{3})"
    r"[\s\p{Z}.\-]\p{Nd}{3}[\s\p{Z}.\-]\p{Nd}{4}(?!\p{Nd})"
)
LONG_NUMBER = r"(?<![\p{Nd}:])\p{Nd}(?:[ \-]?\p{Nd}){11,18}(?![\p{Nd}:])"
# What every phone and every long number contains; cheap to look for first.
PHONE_HINT = r"\p{Nd}{3}[\s\p{Z}.\-]\p{Nd}{4}"
LONG_NUMBER_HINT = r"\p{Nd}(?:[ \-]?\p{Nd}){11}"
START, END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
CAP_TOKEN = r"[A-Z][a-zA-Z'\-]+"
CAP_PAIR = START + "(" + CAP_TOKEN + r")[ \t]+(" + CAP_TOKEN + ")" + END

# Words that follow a greeting without being a name.
NOT_NAMES = [
    "There", "Team", "Support", "Sir", "Madam", "All", "Everyone", "Again", "Customer", "Service",
]

# Capitalised words never taken for a first name.
NOT_FIRST_NAMES = [
    "The", "This", "That", "These", "Those", "Thank", "Thanks", "Hello", "Dear", "Best", "Kind", "Warm",
    "Your", "Our", "My", "New", "Customer", "Support", "Team", "Super", "Study", "Book", "Books", "Case",
    "Money", "Back", "Guarantee", "Order", "Transaction", "Billing", "Please", "Sent", "From", "Subject",
    "Date", "Reply", "Account", "Payment", "Refund", "Cancel",
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
    "January", "February", "March", "April", "June", "July", "August", "September", "October",
    "November", "December", "Google", "Apple", "Amazon", "Chrome", "United", "States",
]

# Greeting and sign-off phrases.
GREETINGS = "Hi|Hello|Hey|Dear|Hiya"
SIGN_OFFS = (
    "Thanks|Thank you|Thank You|Best|Regards|Best regards|Kind regards|Warm regards|Sincerely|Cheers"
    "|Warmly|Respectfully|Thanks again|Many thanks"
)
SAME_LINE_SIGN_OFFS = "Thanks|Thank you|Regards|Best regards|Kind regards|Sincerely|Cheers|Best"

# Name slots in payment-processor mails; NAME marks the slot.
TOKEN = r"[A-Za-z][A-Za-z'\-]+"
NAME_1_3 = rf"({TOKEN}(?:[ \t]+{TOKEN}){{0,2}})"
NAME_1_2 = rf"({TOKEN}(?:[ \t]+{TOKEN})?)"
CAP_1_3 = rf"({CAP_TOKEN}(?:[ \t]+{CAP_TOKEN}){{0,2}})"
TEMPLATES = [
    ("(?i)(?<=change to )", NAME_1_3, r"(?='s[ \t]+billing agreement)"),
    (START, CAP_1_3, r"(?=,?[ \t]*[<(]\[email\][>)])"),
    ("(?i)(?<=The billing agreement for )", NAME_1_3, r"(?=[ \t]+was\b)"),
    (r"(?imd)(?:(?<=agreement\. )|(?<=agreement )|^)", NAME_1_3, r"(?=[ \t]+canceled this billing agreement)"),
    ("(?i)(?<=canceled )", NAME_1_2, r"(?=[ \t]+\(\[email\]\))"),
    (START, CAP_1_3, "(?=, (?:a decision on your case|here are the details))"),
    ("(?i)(?<=notified you that )", NAME_1_3, r"(?=[ \t]+(?:filed|opened|has|asked))"),
    (r"(?i)(?<=Buyer's name[ \t])", NAME_1_3, r"(?=[ \t]+Buyer)"),
    ("(?i)(?<=Buyer: )", NAME_1_3, ""),
    ("(?i)(?<=Buyer name: )", NAME_1_3, ""),
]
TEMPLATE_HINT = r"(?i)billing agreement|\[email\]|decision on your case|are the details|notified you that|buyer"

# A closing line that is only a short name; a subject ending in one.
SIGNATURE_LINE = r"^[ \t]*[-—]?[ \t]*[A-Z][a-z]+(?:[ \t]+[A-Z]\.?)?(?:[ \t]+[A-Z][a-zA-Z'\-]+)?[ \t]*$"
SUBJECT_NAME = (
    r"^((?:Re:\s*)?(?:Cancel(?:lation)?|Refund)[^\-–—]*[\-–—]\s*)([A-Z][a-z]+(?:\s+[A-Z][a-zA-Z'\-]+)?)\s*$"
)


def _none_of(words: Iterable[str], tail: str = END) -> str:
    return "(?!(?:" + "|".join(words) + ")" + tail + ")"


def mask_emails(c: Column | str) -> Column:
    c = col(c)
    return F.when(F.contains(c, F.lit("@")), F.regexp_replace(c, EMAIL, "[email]")).otherwise(c)


def mask_phones(c: Column | str) -> Column:
    c = col(c)
    return F.when(c.rlike(PHONE_HINT), F.regexp_replace(c, PHONE, "[phone]")).otherwise(c)


def mask_long_numbers(c: Column | str) -> Column:
    c = col(c)
    return F.when(c.rlike(LONG_NUMBER_HINT), F.regexp_replace(c, LONG_NUMBER, "[number]")).otherwise(c)


def mask_contacts(c: Column | str) -> Column:
    """Emails, then phones, then other runs of 12 to 19 digits. A text without any
    digits or @ is only looked at."""
    c = col(c)
    masked = let(mask_emails(c), lambda e: let(mask_phones(e), mask_long_numbers))
    return F.when(c.rlike(r"@|\p{Nd}{3}|\p{Nd}[ \-]\p{Nd}"), masked).otherwise(c)


def name_list(*names: Column) -> Column:
    """Names of one record as an array: trimmed, three letters or more, longest first."""
    usable = F.filter(F.transform(F.array_distinct(F.flatten(F.array(*names))), strip), lambda n: F.char_length(n) >= 3)
    return longest_first(usable)


def longest_first(names: Column) -> Column:
    ranked = F.transform(names, lambda n: F.struct((-F.char_length(n)).alias("k"), n.alias("n")))
    return F.transform(F.sort_array(ranked), lambda s: s["n"])


# Letters outside ASCII that match an ASCII letter when case is ignored.
FOLDS = "[\u0131\u0130\u0307\u017F\u212A]"


def mask_each(text: Column, names: Column, tail: str = "", flags: str = "(?iu)") -> Column:
    """Replace every whole-word occurrence of every name of the array."""

    def replace_one(t: Column, n: Column) -> Column:
        literal = F.replace(n, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
        return F.regexp_replace(t, F.concat(F.lit(flags + START + "\\Q"), literal, F.lit("\\E" + tail + END)), F.lit(MASK))

    def replace_found(low: Column) -> Column:
        # a pattern is only built for names the text holds; other letters fold to i, k and s as well
        if "i" in flags:
            maybe = lambda n: F.contains(low, F.lower(n)) | ~n.rlike(r"^\p{ASCII}+\z") | low.rlike(FOLDS)
        else:
            maybe = lambda n: F.contains(low, n)
        return F.aggregate(F.filter(names, maybe), text, replace_one)

    low = F.lower(text) if "i" in flags else text
    return F.when(F.coalesce(F.size(names), F.lit(0)) > 0, let(low, replace_found)).otherwise(text)


def mask_greeting(c: Column, stop: Iterable[str] = ()) -> Column:
    stop = [*NOT_NAMES, *stop]
    name = _none_of(stop) + r"[A-Z][a-z]+(?:[ \t]+[A-Z][a-z]+)?" + END
    return F.regexp_replace(c, START + f"({GREETINGS})" + r"(,?[ \t]+)" + name, "$1$2" + MASK)


def mask_sign_off(c: Column, stop: Iterable[str] = ()) -> Column:
    stop = [*NOT_NAMES, *stop]
    gap = r"([,!.]?[ \t]*\r?\n+[ \t]*[-—]?[ \t]*)"
    name = _none_of(stop) + r"[A-Z][a-z]+[a-zA-Z'\-]*(?:[ \t]+[A-Z][a-zA-Z'\-]+)?"
    return F.regexp_replace(c, START + f"({SIGN_OFFS})" + gap + name, "$1$2" + MASK)


def mask_same_line_sign_off(c: Column, stop: Iterable[str] = ()) -> Column:
    stop = [*NOT_NAMES, *NOT_FIRST_NAMES, *stop]
    name = _none_of(stop) + r"[A-Z][a-z]+(?:[ \t]+[A-Z][a-zA-Z'\-]+)?"
    return F.regexp_replace(
        c, "(?md)" + START + f"({SAME_LINE_SIGN_OFFS})" + r"([,!.]?[ \t]+)" + name + r"[ \t.]*$", "$1$2" + MASK
    )


def mask_signature(c: Column, stop: Iterable[str] = ()) -> Column:
    """Mask the closing line when it is only a short name and not the whole text."""
    stop = [*NOT_NAMES, *NOT_FIRST_NAMES, *stop]
    t = F.rtrim(c, F.lit(WHITESPACE))
    last = F.substring_index(t, "\n", -1)
    head = F.left(t, F.char_length(t) - F.char_length(last))
    line = strip(last)
    opener = F.regexp_replace(F.regexp_extract(line, r"^(\S+)", 1), "^[-—]+", "")
    is_name = (F.char_length(line) <= 40) & line.rlike(SIGNATURE_LINE) & ~opener.isin(stop)
    signed = F.when(is_name, F.concat(head, F.lit(MASK))).otherwise(t)
    return F.when(strip(head) != "", signed).otherwise(c)


def mask_subject_name(c: Column) -> Column:
    return F.regexp_replace(c, SUBJECT_NAME, "$1" + MASK)


def _templates(stop: Iterable[str]) -> list[str]:
    words = _none_of([*NOT_FIRST_NAMES, *stop], r"(?![A-Za-z'\-])").replace("(?!(?:", "(?!(?i:", 1)
    return [before + words + name + after for before, name, after in TEMPLATES]


def template_names(c: Column, stop: Iterable[str] = ()) -> Column:
    """Names found in the name slots of payment-processor mails, longest first."""
    found = [F.regexp_extract_all(c, F.lit(rx), F.lit(1)) for rx in _templates(stop)]
    names = F.filter(F.array_distinct(F.flatten(F.array(*found))), lambda n: F.char_length(n) >= 4)
    return F.when(c.rlike(TEMPLATE_HINT), longest_first(names))


def mask_templates(c: Column, stop: Iterable[str] = ()) -> Column:
    masked = c
    for rx in _templates(stop):
        masked = F.regexp_replace(masked, rx, MASK)
    return F.when(c.rlike(TEMPLATE_HINT), masked).otherwise(c)


def scrub(
    text: Column | str, own: Column | None = None, pairs: Column | None = None, stop: Iterable[str] = ()
) -> Column:
    """The masks every free text gets, in order: contacts, the record's own names,
    full names known from any export, greeting and next-line sign-off names."""
    t = mask_contacts(text)
    if own is not None:
        t = mask_each(t, own)
    if pairs is not None:
        t = mask_each(t, pairs, flags="")
    return mask_sign_off(mask_greeting(t, stop), stop)


def mask_mail_names(c: Column, firsts: Column | None = None, stop: Iterable[str] = ()) -> Column:
    """Names in payment-processor mails, wherever they appear in the text, and pairs
    that begin with a first name known from any export."""
    t = mask_each(mask_templates(c, stop), template_names(c, stop))
    return t if firsts is None else mask_each(t, firsts, tail=r"[ \t]+" + CAP_TOKEN, flags="")


def scrub_mail(scrubbed: Column, firsts: Column | None = None, stop: Iterable[str] = ()) -> Column:
    """Further masks for mail-like text that ``scrub`` has already been through.

    The input is used several times: pass a column that is already computed.
    """
    return mask_signature(mask_same_line_sign_off(mask_mail_names(scrubbed, firsts, stop), stop), stop)
