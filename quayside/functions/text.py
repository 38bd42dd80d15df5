"""Text cleaning and text features on native string functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the accepted form of an e-mail address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

BLANK = r"[\s\p{Z}]"
WORD = r"\p{L}\p{N}_"
MARK = "\uE000 "


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(c) -> Column:
    """Runs of blanks become one space; none at the ends."""
    return F.trim(F.regexp_replace(_c(c), f"{BLANK}+", " "))


def strip(c) -> Column:
    return F.regexp_replace(_c(c), f"^{BLANK}+|{BLANK}+$", "")


def title_case(c) -> Column:
    """Upper case after any non-letter, lower case elsewhere: O'Neil-Smith.

    `initcap` starts words at blanks only, so a marked blank is put before each
    letter that follows a non-letter, and taken out again.
    """
    marked = F.regexp_replace(_c(c), r"(?<=[^\p{L}])(?=\p{L})", MARK)
    return F.replace(F.initcap(marked), F.lit(MARK), F.lit(""))


def words(c) -> Column:
    """The blank-separated words; an empty array for blank text."""
    return F.filter(F.split(_c(c), f"{BLANK}+"), lambda w: w != "")


def word_count(c) -> Column:
    return F.size(words(c)).cast("bigint")


def first_word(c) -> Column:
    return F.get(words(c), F.lit(0))


def last_word(c) -> Column:
    return F.try_element_at(words(c), F.lit(-1))


def clean_name(c) -> Column:
    return title_case(squeeze(c))


def clean_email(c) -> Column:
    return F.lower(strip(c))


def is_email(c) -> Column:
    return F.coalesce(_c(c).rlike(EMAIL_PATTERN), F.lit(False))


def email_domain(c) -> Column:
    return F.get(F.split(_c(c), "@"), F.lit(1))


def digits(c) -> Column:
    return F.regexp_replace(_c(c).cast("string"), r"\D", "")


def clean_phone(c) -> Column:
    """Ten digits with the country code 91 dropped, else null."""
    d = digits(c)
    local = F.when(d.startswith("91") & (F.length(d) > 10), d.substr(F.lit(3), F.length(d))).otherwise(d)
    return F.when(F.length(local) == 10, local)


def show_phone(c) -> Column:
    """'+91 98765 43210' for a cleaned phone."""
    c = _c(c)
    return F.concat(F.lit("+91 "), F.substring(c, 1, 5), F.lit(" "), c.substr(F.lit(6), F.length(c)))


def format_phone(c) -> Column:
    """Display form where the text holds ten digits, else the text as it is."""
    d = digits(c)
    return F.when(F.length(d) == 10, show_phone(d)).otherwise(_c(c))


def clean_address(c) -> Column:
    return title_case(squeeze(c))


def address_city(c) -> Column:
    """The part before the last comma part; null without a comma."""
    return F.trim(F.try_element_at(F.split(_c(c), ","), F.lit(-2)))


def clean_comment(c) -> Column:
    """Drop symbols, keep one of repeated end marks, squeeze, capitalise the first letter."""
    kept = F.regexp_replace(_c(c), f"[^{WORD}\\s\\p{{Z}}.,!?-]", "")
    marks = F.regexp_replace(kept, r"([!?.]){2,}", "$1")
    tidy = squeeze(marks)
    return F.concat(F.upper(F.substring(tidy, 1, 1)), tidy.substr(F.lit(2), F.length(tidy)))


def strip_special(c) -> Column:
    return squeeze(F.regexp_replace(_c(c), f"[^{WORD}\\s\\p{{Z}}]", " "))


def contains_ci(c, needle: str) -> Column:
    return F.lower(_c(c)).contains(needle.lower())


def zero_pad(c, width: int = 10) -> Column:
    """Left zeros up to `width`; longer text is kept whole."""
    text = _c(c).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def indent(c, level, unit: str = "  ") -> Column:
    return F.concat(F.repeat(F.lit(unit), _c(level).cast("int")), _c(c))


def clean_id(c) -> Column:
    return F.upper(strip(c))
