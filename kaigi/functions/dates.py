"""Era dates and the front matter of council minutes, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import half_width_digits

#: The year before each era's second year.
ERAS = {"明治": 1868, "大正": 1912, "昭和": 1926, "平成": 1989, "令和": 2019}
_ERA, _SPACED = "|".join(ERAS), "|".join(rf"{e[0]}\s*{e[1]}" for e in ERAS)
_DAY = r"\s*(元|\d+)\s*年\s*(\d+)\s*月\s*(\d+)\s*日"
_DAY_PLAIN = r"\s*(?:元|\d+)\s*年\s*\d+\s*月\s*\d+\s*日"


def year_number(c: Column) -> Column:
    """元 is 1; other text that is no whole number is null."""
    bare = half_width_digits(F.trim(c))
    return F.when(bare == "元", F.lit(1)).otherwise(bare.try_cast("int"))


def western_year(era: Column, number: Column) -> Column:
    base = F.lit(0)
    for name, year in ERAS.items():
        base = F.when(era == name, F.lit(year)).otherwise(base)
    return base + number - 1


def parse_date(c: Column) -> Column:
    """YYYY-MM-DD of the first era date, not checked against the calendar; null if there is none."""
    text, pattern = half_width_digits(c), f"(?U)({_ERA}){_DAY}"
    part = lambda i: F.regexp_extract(text, pattern, i)
    year = western_year(part(1), year_number(part(2)))
    return F.when(text.rlike(pattern), F.format_string("%04d-%02d-%02d", year, part(3).try_cast("int"), part(4).try_cast("int")))


def front_matter(page: Column) -> Column:
    """struct(nendo, kai, session_type, date_start, date_end) of a first page."""
    t = half_width_digits(page)
    era = rf"(?U)({_SPACED})\s*(元|\d+)\s*年"
    nendo = F.when(t.rlike(era), F.concat(F.replace(F.regexp_extract(t, era, 1), F.lit(" "), F.lit("")), F.trim(F.regexp_extract(t, era, 2)), F.lit("年")))
    kai = F.regexp_extract(t, r"(?U)第\s*(\d+)\s*回", 1).try_cast("int")
    kind = F.when(t.contains("定例会"), "定例会").when(t.contains("臨時会"), "臨時会")
    labelled = lambda mark: parse_date(F.nullif(F.regexp_extract(t, rf"(?U){mark}\s*((?:{_ERA}){_DAY_PLAIN})", 1), F.lit("")))
    every = F.regexp_extract_all(t, F.lit(f"(?U)((?:{_SPACED}){_DAY_PLAIN})"), 1)
    dates = F.filter(F.transform(every, lambda x: parse_date(F.replace(x, F.lit(" "), F.lit("")))), lambda x: x.isNotNull())
    first, start, end = F.try_element_at(dates, F.lit(1)), labelled("自"), labelled("至")
    return F.struct(
        nendo.alias("nendo"),
        kai.alias("kai"),
        kind.alias("session_type"),
        F.coalesce(start, first).alias("date_start"),
        F.when(start.isNotNull(), end).otherwise(F.coalesce(first, end)).alias("date_end"),
    )
