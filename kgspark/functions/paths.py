"""Canonical paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kgspark.functions.ids import strip


def flat_segments(filename: Column) -> Column:
    """Segments of A__B__C.md; null where the name or a segment is empty."""
    parts = F.split(F.regexp_replace(filename, r"\.md$", ""), "__")
    return F.when(F.exists(parts, lambda s: s == ""), F.lit(None)).otherwise(parts)


def nested_segments(relative: Column) -> Column:
    """Segments of a/b/c.md without '.' and empty parts, the leaf without .md; '..' stays."""
    return F.filter(F.split(F.regexp_replace(relative, r"\.md$", ""), "/"), lambda s: ~s.isin(".", ""))


def canonical_path(repo: Column, segments: Column) -> Column:
    return F.concat(repo, F.lit("/"), F.array_join(segments, "/"))


def parent_path(path: Column) -> Column:
    """The path without its leaf; null for two parts or fewer."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/"))


def wikilink(target: Column) -> Column:
    return F.concat(F.lit("[["), target, F.lit("]]"))


def resolve_parent(given: Column, path: Column) -> Column:
    """A given wikilink as it is, a bare one wrapped; the path's parent where none is given."""
    return F.when(F.coalesce(given, F.lit("")) == "", wikilink(parent_path(path))).when(given.startswith("[["), given).otherwise(wikilink(given))


def title_of(segments: Column) -> Column:
    return strip(F.replace(F.element_at(segments, -1), F.lit("_"), F.lit(" ")))


def clean_aliases(aliases: Column, stem: Column) -> Column:
    """Aliases and the file's stem, first occurrences in order, without blanks."""
    return F.array_distinct(F.filter(F.concat(aliases, F.array(stem)), lambda x: x != ""))


def clean_tags(tags: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(tags, strip), lambda x: x != ""))


#: a time of day, and how far it is from UTC, in ISO shapes
_CLOCK = r"[0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2}(?:[.,][0-9]+)?)?)?(?:[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)?"


def coerce_date(c: Column) -> Column:
    """The date that ISO text begins with, as it is written there: no zone is converted.

    A day is 2026-04-27, 20260427 or, by week, 2026-W17-1 or 2026W171, whatever follows
    (behind a form without dashes, two characters or none); a week alone, with a time
    or without, is its Monday; a year, a month or a time alone is null.
    """
    whole = F.regexp_replace(c, "Z+$", "")
    first = lambda *found: F.coalesce(*[F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for t, p in found])
    day = first((c, "^([0-9]{4}-[0-9]{2}-[0-9]{2})"), (c, "(?s)^([0-9]{8}).."), (whole, "^([0-9]{8})$"))
    day = F.regexp_replace(F.replace(day, F.lit("-")), "^(....)(..)(..)$", "$1-$2-$3")
    week = first((c, "^([0-9]{4}-W[0-9]{2}-[1-7])"), (c, "(?s)^([0-9]{4}W[0-9]{2}[1-7]).."), (whole, rf"^([0-9]{{4}}W[0-9]{{2}}[1-7]|[0-9]{{4}}-?W[0-9]{{2}})(?:[^0-9-]{_CLOCK})?$"))
    digits = F.regexp_replace(week, "[-W]", "")
    number = lambda a, n: F.substring(digits, a, n).cast("int")
    fourth = F.try_to_timestamp(F.concat(F.substring(digits, 1, 4), F.lit("-01-04")), F.lit("yyyy-MM-dd")).cast("date")
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (number(5, 2) - 1) * 7)
    by_week = F.when(number(5, 2).between(1, 53) & (F.year(F.date_add(monday, 3)) == number(1, 4)), F.date_add(monday, F.coalesce(F.nullif(F.substring(digits, 7, 1), F.lit("")).cast("int") - 1, F.lit(0))))
    by_day = F.when(~day.startswith("0000"), F.try_to_timestamp(day, F.lit("yyyy-MM-dd")).cast("date"))
    return F.coalesce(by_day, by_week)


def article_url(base: Column, title: Column) -> Column:
    """The wiki page of a title, spaces as underscores."""
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/wiki/"), F.replace(title, F.lit(" "), F.lit("_")))


def version_tag(at: Column) -> Column:
    return F.date_format(at, "'graph-v'yyyyMMddHHmmss")


def run_id(at: Column) -> Column:
    return F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")
