"""Text functions as JVM-side column expressions. ``\\s`` and ``\\w`` are Unicode throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import patterns


def strip(c: Column) -> Column:
    """Without white space at both ends (all Unicode white space, not only blanks)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def filled(c: Column) -> Column:
    """The value, or null where it is an empty string."""
    return F.nullif(c, F.lit(""))


def word_count(c: Column) -> Column:
    """Number of runs without white space; 0 for null and blank text."""
    return F.coalesce(F.size(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")), F.lit(0))


def token_estimate(c: Column, rate: float = 1.3) -> Column:
    return F.floor(word_count(c) * rate).cast("int")


def token_budget(c: Column, least: int = 8192, factor: float = 3.0) -> Column:
    """Most tokens an answer about the text may take."""
    return F.greatest(F.lit(least), F.floor(token_estimate(c) * factor).cast("int"))


def sanitize_tag(c: Column) -> Column:
    """A tag as lower-case words joined by single hyphens; empty if nothing is left."""
    v = F.regexp_replace(strip(F.lower(c)), r"(?U)[\s_/\-:]+", "-")
    v = F.regexp_replace(F.regexp_replace(v, r"(?U)[^\w\-]", ""), "-+", "-")
    return F.regexp_replace(v, "^-+|-+$", "")


def sanitize_tags(c: Column) -> Column:
    """Sanitised tags in first-seen order, without empties and repeats; null becomes an empty list."""
    tags = F.filter(F.transform(c, sanitize_tag), lambda t: t.isNotNull() & (t != ""))
    return F.coalesce(F.array_distinct(tags), F.array().cast("array<string>"))


def theme_term(c: Column) -> Column:
    """The term that a theme tag stands for in frequency counts."""
    return F.lower(strip(F.translate(c, "-_", "  ")))


def slug(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit(" "), F.lit("-")))


def normal_gender(c: Column) -> Column:
    from lectern.model import GENDERS

    v = F.lower(strip(c))
    return F.when(v.isin(*GENDERS), v).otherwise("unknown")


def paragraphs(c: Column) -> Column:
    """Non-empty paragraphs, parted by lines without a visible character."""
    line_end, blank_line = r"\r?\n", r"(?:[^\S\n]*\n)+"
    return F.filter(F.transform(F.split(c, f"(?U){line_end}{blank_line}"), strip), lambda p: p != "")


def joined_lines(c: Column) -> Column:
    """A paragraph on one line: a word that a line end parts at its hyphen is made whole, white space collapsed."""
    whole = F.regexp_replace(c, r"(?U)(?<=\w)-\n\s*(?=\w)", "")
    return strip(F.regexp_replace(whole, r"(?U)\s+", " "))


def content_address(c: Column) -> Column:
    """SHA-256 of the text in UTF-8."""
    return F.sha2(c, 256)


def uuid7(at: Column, *keys: Column) -> Column:
    """A version 7 UUID from a timestamp's milliseconds and a hash of the keys: the same input, the same id."""
    ms = F.lpad(F.lower(F.hex(F.unix_millis(at.cast("timestamp")))), 12, "0")
    h = F.sha2(F.concat_ws("\0", *keys), 256)
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(h, 4, 1), 16, 10).cast("int") + 1, 1)
    return F.concat(F.substring(ms, 1, 8), F.lit("-"), F.substring(ms, 9, 4), F.lit("-7"), F.substring(h, 1, 3), F.lit("-"), variant, F.substring(h, 5, 3), F.lit("-"), F.substring(h, 9, 12))


def stamp(at: Column | None = None) -> Column:
    """A run's time as 14 digits."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyyMMddHHmmss")


def thread_identity(url: Column) -> tuple[Column, Column]:
    """(thread id, decoded slug) of a forum thread address; empty strings where there is none."""
    return F.regexp_extract(url, patterns.THREAD_URL, 2), F.url_decode(F.regexp_extract(url, patterns.THREAD_URL, 1))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, 0 for an empty whole."""
    return F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))
