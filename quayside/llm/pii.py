"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

DataFrame operations only. The kinds of the base (email, ip, card, phone) are
kept whenever they are valid; the kinds that the method adds (iban, and cards
of 13 to 15 digits) need a score of at least `KEEP`, which the words before and
behind them decide. An account number has the length of its country, whatever
follows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.spans import Kind, digest, matches

#: The length of an account number by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31,
    "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
# By country and length; blanks may part the signs, and none follows the last. A country that is not listed has no number.
IBAN = r"(?<![A-Za-z0-9])(?:" + "|".join(
    rf"(?:{'|'.join(sorted(c for c, n in IBAN_LENGTH.items() if n == size))})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{size - 4}}}"
    for size in sorted(set(IBAN_LENGTH.values()))) + r")(?![A-Za-z0-9])"

# A match can only start where a run starts or the last match ended; saying so keeps long runs linear.
KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    Kind("iban", IBAN, r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
    Kind("short_card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]"),
]
NAMES = [k.name for k in KINDS]
BASE = 4
KEEP = 0.5

#: What a valid span of each kind is worth alone, and the words near it that add or take.
PRIOR = [0.9, 0.7, 0.8, 0.7, 0.7, 0.3]
NEAR = [
    r"mail|contact|write|kontakt|correo|courriel", r"\bip\b|host|server|addr|adresse", r"card|visa|karte|carte|tarjeta|credit|pay",
    r"phone|tel|call|mobil|fax|anruf|appel|llam", r"iban|account|bank|konto|compte|cuenta", r"card|amex|karte|carte|tarjeta|credit|pay",
]
AGAINST = r"version|release|build|order|invoice|isbn|serial|sku|ticket"


def luhn(digits: Column) -> Column:
    """True where the digits pass the Luhn checksum."""
    worth = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        c == "", 0).when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """True where an account code, its first four signs moved to the end and letters counted from 10, leaves 1."""
    moved = F.concat(F.substring(code, 5, 99), F.substring(code, 1, 4))

    def step(a: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def valid() -> Column:
    """Whether the match `hit` of `kind` passes the checks of its kind."""
    hit, kind = F.col("hit"), F.col("kind")
    digits = F.regexp_replace(hit, "[^0-9]", "")
    size = F.char_length(digits)
    plain = F.regexp_replace(hit, r"\x20", "")

    def small(part: Column) -> Column:
        p = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(F.char_length(p) <= 3, p.cast("int") <= 255).otherwise(False)

    return (
        F.when(kind == 0, True)
        .when(kind == 1, F.forall(F.split(hit, r"\."), small))
        .when(kind == 2, F.when(size.between(16, 19), luhn(digits)).otherwise(False))
        .when(kind == 3, size.between(8, 15))
        .when(kind == 4, F.when(F.char_length(plain).between(15, 34), mod97(plain)).otherwise(False))
        .when(kind == 5, F.when(size.between(13, 15), luhn(digits)).otherwise(False))
        .otherwise(False)
    )


def score() -> Column:
    """Prior of the kind, moved by the words shortly before and behind the span, within 0 and 1.

    A word against it counts before the span only: what follows mostly belongs
    to the next item.
    """
    before = F.lower("before")
    around = F.concat_ws(" ", before, F.lower("behind"))
    near = F.lit(False)
    for k, words in enumerate(NEAR):
        near = F.when(F.col("kind") == k, around.rlike(words)).otherwise(near)
    prior = F.element_at(F.array(*[F.lit(p) for p in PRIOR]), F.col("kind") + 1)
    moved = prior + F.when(near, 0.3).otherwise(0.0) - F.when(before.rlike(AGAINST), 0.3).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), moved))


def scored(docs: DataFrame) -> DataFrame:
    """All matches with `valid`, `score` and `kept`; texts without a match have one row with a null kind."""
    found = matches(docs, KINDS).withColumn("valid", F.when(F.col("kind").isNotNull(), valid()).otherwise(False))
    found = found.withColumn("score", F.when(F.col("valid"), score()))
    return found.withColumn("kept", F.col("valid") & ((F.col("kind") < BASE) | (F.col("score") >= KEEP)))


def personal_spans(docs: DataFrame) -> DataFrame:
    """One row per kept span: doc_id, kind, start, end, value, score."""
    name = F.element_at(F.array(*[F.lit(n) for n in NAMES]), F.col("kind") + 1)
    return scored(docs).where("kept").select(
        "doc_id", name.alias("kind"), "start", "end", F.col("hit").alias("value"), "score")


def personal_digest(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Null and empty texts have no spans and the hash of the empty string;
    repeated rows and null ids each come back; an empty table gives no rows.
    """
    return digest(scored(docs), NAMES, BASE, F.col("kept"), by_start=False)
