"""Date functions over text and date columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed formats, tried in order, each behind a guard: Java's patterns are laxer.
FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}$", "yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^[A-Z][a-z]{3,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"),
)


def parse(text: Column) -> Column:
    """A date from one of FORMATS, or from a BCE year, whose sign is lost; else null."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    tries = [F.when(t.rlike(guard), F.try_to_date(t, shape)) for guard, shape in FORMATS]
    year = F.regexp_extract(t, r"(?i)^(\d+)\s*BC", 1).try_cast("int")
    bce = F.when(year.isNotNull() & (year <= 9999), F.make_date(F.greatest(F.lit(1), year), F.lit(1), F.lit(1)))
    return F.coalesce(*tries, bce)


def diff(a: Column, b: Column) -> list[Column]:
    """days, years, months, rest: years of 365 days, months of 30."""
    days = F.abs(F.datediff(a, b)).cast("long")
    return [days.alias("days"), F.floor(days / 365).alias("years"), F.floor((days % 365) / 30).alias("months"), ((days % 365) % 30).alias("rest")]


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> list[Column]:
    """overlaps, and days: of the overlap, or else from the earlier start to the
    later end (the outer span)."""
    meets = (s1 <= e2) & (s2 <= e1)
    inner = F.datediff(F.least(e1, e2), F.greatest(s1, s2))
    outer = F.abs(F.datediff(F.least(s1, s2), F.greatest(e1, e2)))
    return [meets.alias("overlaps"), F.when(meets, inner).otherwise(outer).cast("long").alias("days")]


def add(d: Column, n: Column, unit: Column) -> Column:
    """Days and weeks exactly; months with the day cut to 28; years with the same
    day, null for a 29 February that isn't there."""
    n = n.cast("int")
    months = F.year(d) * 12 + F.month(d) - 1 + n
    by_month = F.make_date(F.floor(months / 12).cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), F.least(F.day(d), F.lit(28)))
    leap = (F.pmod(F.year(d) + n, F.lit(4)) == 0) & ((F.pmod(F.year(d) + n, F.lit(100)) != 0) | (F.pmod(F.year(d) + n, F.lit(400)) == 0))
    by_year = F.when((F.month(d) == 2) & (F.day(d) == 29) & ~leap, F.lit(None).cast("date")).otherwise(F.make_date(F.year(d) + n, F.month(d), F.least(F.day(d), F.when((F.month(d) == 2) & ~leap, 28).otherwise(31))))
    return F.when(unit == "day", F.date_add(d, n)).when(unit == "week", F.date_add(d, n * 7)).when(unit == "month", by_month).when(unit == "year", by_year)


def chronological(df: DataFrame, date: str, pos: str, by: list[str] | None = None) -> DataFrame:
    """Rows with a date, numbered from 1 in order of it, ties as they came."""
    w = Window.partitionBy(*(by or [])).orderBy(date, pos)
    return df.filter(F.col(date).isNotNull()).withColumn("place", F.row_number().over(w))


def operation(request: Column) -> Column:
    """Which date operation a request starts with; null if none."""
    t = F.lower(F.ltrim(request))
    out = F.lit(None).cast("string")
    for name in ("add", "overlap", "order", "diff"):
        out = F.when(t.startswith(name), F.lit(name)).otherwise(out)
    return out


def answer(request: Column) -> Column:
    """The reply to ``diff a, b``, ``add date, n unit``, ``overlap a - b, c - d`` of
    years and ``order name: date; ...``; null if it can't be read."""
    rest = F.regexp_replace(F.ltrim(request), r"(?i)^(?:diff|order|overlap|add)[:\s]*", "")
    parts = F.split(rest, r"\s*,\s*(?=\S)", 2)
    a, b = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    days, years, months, left = diff(parse(a), parse(b))
    differs = F.concat(days, F.lit(" days ("), years, F.lit(" years, "), months, F.lit(" months, "), left, F.lit(" days)"))
    n = F.regexp_extract(b, r"^\s*([+-]?\d+)\s*([a-z]+?)s?\s*$", 1).try_cast("int")
    unit = F.regexp_extract(b, r"^\s*([+-]?\d+)\s*([a-z]+?)s?\s*$", 2)
    added = F.date_format(add(parse(a), n, unit), "yyyy-MM-dd")
    span = lambda x, k: parse(F.regexp_extract(x, r"^\s*(\d{4})\s*-\s*(\d{4})\s*$", k))
    meets, long = overlap(span(a, 1), span(a, 2), span(b, 1), span(b, 2))
    overlaps = F.when(meets, F.concat(F.lit("overlap of "), long, F.lit(" days"))).when(~meets, F.concat(F.lit("no overlap, gap of "), long, F.lit(" days")))
    named = F.transform(F.split(rest, r"\s*;\s*"), lambda x, i: F.struct(parse(F.element_at(F.split(x, ":\\s*", 2), -1)).alias("d"), i.alias("i"), x.alias("x")))
    inorder = F.array_sort(F.filter(named, lambda x: x["d"].isNotNull()))
    listed = F.nullif(F.array_join(F.transform(inorder, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["x"])), "\n"), F.lit(""))
    kind = operation(request)
    return F.when(kind == "diff", differs).when(kind == "add", added).when(kind == "overlap", overlaps).when(kind == "order", listed)
