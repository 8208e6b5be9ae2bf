"""French public holidays as a rule, and user calendars as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattgrid.functions.timeaxis import quoted

# Month * 100 + day of the holidays with a fixed date.
FIXED_DAYS = [101, 501, 508, 714, 815, 1101, 1111, 1225]
# Days after Easter Sunday of Easter Monday, Ascension and Whit Monday.
EASTER_MONDAY, ASCENSION, WHIT_MONDAY = 1, 39, 50
# Whit Monday was a working day in these years.
WHIT_MONDAY_WORKED = (2005, 2007)


def with_easter(df: DataFrame, year: str, name: str) -> DataFrame:
    """Add Gregorian Easter Sunday of an integer year column (Meeus / Jones / Butcher rule).

    Each step is a column of its own, so no step is evaluated twice.
    """
    y = quoted(year)
    century, rest = f"({y} div 100)", f"({y} % 100)"
    shift = f"(({century} - ({century} + 8) div 25 + 1) div 3)"
    moon = f"(19 * ({y} % 19) + {century} - {century} div 4 - {shift} + 15) % 30"
    weekday = f"(32 + 2 * ({century} % 4) + 2 * ({rest} div 4) - __moon - {rest} % 4) % 7"
    days = f"__moon + __weekday - 7 * (({y} % 19 + 11 * __moon + 22 * __weekday) div 451) + 114"
    stepped = df.selectExpr("*", f"{moon} AS __moon").selectExpr("*", f"{weekday} AS __weekday")
    counted = stepped.selectExpr("*", f"{days} AS __days")
    easter = f"make_date({y}, cast(__days div 31 AS int), cast(__days % 31 + 1 AS int))"
    return counted.selectExpr("*", f"{easter} AS {quoted(name)}").drop("__moon", "__weekday", "__days")


def flag_french_holidays(df: DataFrame, ts: str = "ts", name: str = "is_holiday") -> DataFrame:
    """Flag public holidays in France as TINYINT, from the date alone: no join."""
    dated = with_easter(df.selectExpr("*", f"year({quoted(ts)}) AS __year"), "__year", "__easter")
    after = dated.selectExpr("*", f"datediff(cast({quoted(ts)} AS date), __easter) AS __after")
    first, last = WHIT_MONDAY_WORKED
    fixed = ", ".join(map(str, FIXED_DAYS))
    rule = (
        f"month({quoted(ts)}) * 100 + day({quoted(ts)}) IN ({fixed}) OR __after IN ({EASTER_MONDAY}, {ASCENSION}) "
        f"OR (__after = {WHIT_MONDAY} AND __year NOT BETWEEN {first} AND {last})"
    )
    return after.selectExpr(*[quoted(c) for c in df.columns], f"cast({rule} AS tinyint) AS {quoted(name)}")


def flag_dates(df: DataFrame, calendar: DataFrame, ts: str = "ts", name: str = "is_holiday") -> DataFrame:
    """Flag rows whose date is in ``calendar(date)``; Spark picks the join by the measured size."""
    days = calendar.select(F.col("date").cast("date").alias("__day")).distinct().withColumn("__hit", F.lit(1))
    keyed = df.withColumn("__day", F.col(ts).cast("date"))
    flagged = keyed.join(days, "__day", "left")
    return flagged.withColumn(name, F.coalesce("__hit", F.lit(0)).cast("byte")).drop("__day", "__hit")
