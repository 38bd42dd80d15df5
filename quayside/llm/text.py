"""Small text helpers shared by the operators of this package."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that separates words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    Pure ASCII texts, told by equal byte and character lengths, take the fast
    built-in; the rest is translated so that letters beyond A-Z stay as they are.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for a text without words."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that further ones can't clash with those an operator adds."""
    return docs.select(*[docs[c] for c in columns])


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text, null texts as empty."""
    return docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo `parts`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def hash_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """All rows when there are at most `size`, else those whose key hashes below the share that gives about `size`.

    The rows are counted first; nothing is gathered in one task.
    """
    total = df.count()
    if total <= size:
        return df
    parts = 1 << 40
    return df.where(F.pmod(F.xxhash64(F.lit(17), df[key]), F.lit(parts)) < size * parts // total)
