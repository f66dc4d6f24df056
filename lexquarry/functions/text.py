"""Scalar expressions on text, addresses and URLs; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of no width, and white space as Unicode and the C0 separators have it.
ZERO_WIDTH = "​‌‍﻿"
SPACES = r"(?U)[\x1c-\x1f\s]+"


def normalised(text: Column, zero_width: bool = True) -> Column:
    """White space as single spaces, none at the ends; characters of no width removed."""
    clean = F.translate(text, ZERO_WIDTH, "") if zero_width else text
    return F.trim(F.regexp_replace(clean, SPACES, " "))


def slug(text: Column) -> Column:
    """Lower-case letters and digits in runs joined by hyphens."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def url_parts(url: Column) -> dict[str, Column]:
    """Scheme, host, path without trailing slashes, and fragment; empty where missing, null for null."""
    return {
        "scheme": F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)),
        "host": F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)),
        "path": F.regexp_replace(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1), "/+$", ""),
        "fragment": F.regexp_extract(url, "#(.*)$", 1),
    }


def canonical_url(url: Column, base: str = "") -> Column:
    """Scheme and lower-case host with the path; no query, fragment or trailing slash."""
    part = url_parts(url)
    whole = F.concat(part["scheme"], F.lit("://"), part["host"], part["path"])
    return F.when(part["host"] != "", whole).otherwise(F.concat(F.lit(base.rstrip("/")), part["path"]))


def path_prefixes(path: Column) -> Column:
    """All proper prefixes of a path by its segments, longest first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, F.size(parts) - n), "/"))


def natural_key(ref: Column) -> Column:
    """Sort key of an address: by segment, numbers before words and by value."""
    return F.transform(
        F.split(ref, "[/.]"),
        lambda s: F.struct(
            F.when(F.regexp_extract(s, "([0-9]+)", 1) == "", F.lit(1)).otherwise(F.lit(0)).alias("kind"),
            F.coalesce(F.regexp_extract(s, "([0-9]{1,15})", 1).try_cast("long"), F.lit(0)).alias("number"),
            s.alias("word"),
        ),
    )


def part_order(part: Column) -> Column:
    """Sort key of a part id: number, then suffix; ids without a number last."""
    return F.struct(F.coalesce(F.regexp_extract(part, "([0-9]{1,15})", 1).try_cast("long"), F.lit(1_000_000)), F.regexp_extract(part, "[0-9]+(.*)$", 1))


def filled(value: Column) -> Column:
    """Null for an empty string, as truth tests of text have it."""
    return F.when(value != "", value)


def file_stem(ref: Column) -> Column:
    return F.replace(ref, F.lit("/"), F.lit("-"))


def escaped_cell(value: Column) -> Column:
    """A Markdown table cell."""
    return F.replace(F.coalesce(value, F.lit("")), F.lit("|"), F.lit("\\|"))
