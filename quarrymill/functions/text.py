"""Column functions on text: normalisation, words, token estimates, sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(c: Column) -> Column:
    """White space runs as one blank, none at the ends; null stays null."""
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))


def fold(c: Column) -> Column:
    """Clean text for comparison without case; the sharp s counts as ss."""
    return F.replace(F.lower(clean(c)), F.lit("ß"), F.lit("ss"))


def words(c: Column) -> Column:
    """Maximal runs of letters and digits of the lower-cased text, in order; empty for null."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def token_estimate(c: Column) -> Column:
    """Tokens without a tokenizer: a quarter of each ASCII word's length rounded up, one for each other ASCII sign, the bytes of the rest."""
    runs = F.regexp_extract_all(c, F.lit("[A-Za-z0-9]+"), F.lit(0))
    word = F.aggregate(runs, F.lit(0).cast("bigint"), lambda a, x: a + F.ceil(F.length(x) / 4))
    signs = F.length(F.regexp_replace(c, r"[A-Za-z0-9 \t\r\n]|[^\x00-\x7F]", ""))
    rest = F.regexp_replace(c, r"[\x00-\x7F]", "")
    return (word + signs + F.octet_length(rest)).cast("bigint")


def sentences(c: Column) -> Column:
    """Sentences of a text: cut after . ! ? before white space, and at line breaks; empty ones dropped."""
    marked = F.regexp_replace(F.coalesce(c, F.lit("")), r"([.!?؟])[ \t]+", "$1\n")
    return F.filter(F.transform(F.split(marked, r"[\r\n]+"), lambda s: F.trim(s)), lambda s: s != "")


def stable_id(length: int, *parts: Column) -> Column:
    """The first `length` hex digits of the SHA-1 of the non-empty parts joined by |."""
    return F.substring(F.sha1(F.concat_ws("|", *(F.nullif(F.coalesce(p.cast("string"), F.lit("")), F.lit("")) for p in parts))), 1, length)


def stable_fraction(c: Column) -> Column:
    """A fixed number in [0, 1) for a key: the first 12 hex digits of its SHA-256 over 16 to the 12th."""
    return F.conv(F.substring(F.sha2(c.cast("string"), 256), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
