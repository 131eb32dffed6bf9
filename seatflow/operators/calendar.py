"""Calendar features and Swedish public holidays."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.functions.clock import date_spine, iso_date

# Days kept as public holidays or as eves, with the first and last year of each.
# A rule gives month and day, or days from Easter Sunday, or days from the first Saturday on or
# after month and day.
HOLIDAY_RULES = [
    ("New Year", "public", "fixed", 1, 1, 0, 0, 9999),
    ("Epiphany", "public", "fixed", 1, 6, 0, 0, 9999),
    ("Good Friday", "public", "easter", 0, 0, -2, 0, 9999),
    ("Easter Eve", "eve", "easter", 0, 0, -1, 0, 9999),
    ("Easter Sunday", "public", "easter", 0, 0, 0, 0, 9999),
    ("Easter Monday", "public", "easter", 0, 0, 1, 0, 9999),
    ("Labour Day", "public", "fixed", 5, 1, 0, 1939, 9999),
    ("Ascension", "public", "easter", 0, 0, 39, 0, 9999),
    ("Whit Sunday", "public", "easter", 0, 0, 49, 0, 9999),
    ("Whit Monday", "public", "easter", 0, 0, 50, 0, 2004),
    ("National Day", "public", "fixed", 6, 6, 0, 2005, 9999),
    ("Midsummer Eve", "eve", "saturday", 6, 20, -1, 1953, 9999),
    ("Midsummer Day", "public", "saturday", 6, 20, 0, 1953, 9999),
    ("All Saints", "public", "saturday", 10, 31, 0, 1953, 9999),
    ("Christmas Eve", "eve", "fixed", 12, 24, 0, 0, 9999),
    ("Christmas Day", "public", "fixed", 12, 25, 0, 0, 9999),
    ("Boxing Day", "public", "fixed", 12, 26, 0, 0, 9999),
    ("New Year Eve", "eve", "fixed", 12, 31, 0, 0, 9999),
]
_RULE_FIELDS = "name, category, kind, month, day, shift, since, until"


def easter_sunday(year: str) -> Column:
    """Gregorian Easter Sunday of a year column, by century and lunar correction."""
    century = f"({year} div 100)"
    moon = (
        f"((19 * ({year} % 19) + {century} - {century} div 4"
        f" - (({century} - ({century} + 8) div 25 + 1) div 3) + 15) % 30)"
    )
    sunday = f"((32 + 2 * ({century} % 4) + 2 * (({year} % 100) div 4) - {moon} - ({year} % 4)) % 7)"
    late = f"((({year} % 19) + 11 * {moon} + 22 * {sunday}) div 451)"
    days = f"({moon} + {sunday} - 7 * {late})"
    return F.expr(f"date_add(make_date({year}, 3, 22), int({days}))")


def holidays(spark: SparkSession, first_year: int, last_year: int, include_eves: bool = False) -> DataFrame:
    """(date, name, category), about fifteen rows per year."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    rules = ", ".join(f"struct{rule}" for rule in HOLIDAY_RULES)
    rows = years.withColumn("easter", easter_sunday("year")).selectExpr(
        "year", "easter", f"inline(array({rules})) as ({_RULE_FIELDS})"
    )
    rows = rows.where("year between since and until")
    base = F.expr("""
        case kind when 'easter' then easter
            when 'saturday' then next_day(date_sub(make_date(year, month, day), 1), 'Sat')
            else make_date(year, month, day) end
    """)
    rows = rows.select(F.date_add(base, F.col("shift")).alias("date"), "name", "category")
    return rows if include_eves else rows.where("category = 'public'")


def _free_day(day: Column, easter: Column, include_eves: bool) -> Column:
    """Whether `day` is kept by one of the rules, by its own year."""
    year = F.year(day)
    free = F.lit(False)
    for _, category, kind, month, number, shift, since, until in HOLIDAY_RULES:
        if category != "public" and not include_eves:
            continue
        if kind == "easter":
            base = easter
        else:
            base = F.make_date(year, F.lit(month), F.lit(number))
            base = F.next_day(F.date_sub(base, 1), "Sat") if kind == "saturday" else base
        free = free | ((day == F.date_add(base, shift)) & year.between(since, until))
    return free


def calendar_features(
    days: DataFrame, column: str = "date", include_sundays: bool = False, include_eves: bool = False
) -> DataFrame:
    """Month, weekday, weekend, holiday and workday of each day, in any year."""
    rows = days.withColumn("_day", F.to_date(column)).withColumn("_easter", easter_sunday("year(_day)"))
    weekend = F.weekday("_day") >= 5
    holiday = F.coalesce(_free_day(F.col("_day"), F.col("_easter"), include_eves), F.lit(False))
    if include_sundays:
        holiday = holiday | (F.weekday("_day") == 6)
    return rows.withColumns({
        "month": F.month("_day"),
        "weekday": F.date_format("_day", "EEEE"),
        "is_weekend": weekend,
        "is_holiday_se": holiday,
        "is_workday_se": ~weekend & ~holiday,
        column: iso_date("_day"),
    }).drop("_day", "_easter")


def calendar_between(spark: SparkSession, first: str | date, last: str | date, **options) -> DataFrame:
    """Calendar features for every day first..last."""
    return calendar_features(date_spine(spark, first, last), **options)
