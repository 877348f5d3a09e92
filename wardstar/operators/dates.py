"""The date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardstar.functions.scalars import bucket

# Window of the dates given to rows without one.
NULL_DATE_START = "2020-01-01"
NULL_DATE_DAYS = 1000


def date_attributes(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "month_name": F.date_format(date, "MMMM"),
        "day_of_week": F.date_format(date, "EEEE"),
    }


def date_dimension(*dates: DataFrame) -> DataFrame:
    """One row per distinct non-null date of one-column tables, with all derived columns."""
    every = dates[0].toDF("date_key")
    for other in dates[1:]:
        every = every.union(other.toDF("date_key"))
    return every.dropna().distinct().withColumns(date_attributes(F.col("date_key")))


def new_dates(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Dates of ``candidates`` that the dimension does not hold yet."""
    return date_dimension(candidates).join(existing.select("date_key"), "date_key", "left_anti")


def repair_dates(dim_date: DataFrame) -> DataFrame:
    """Recompute the derived columns of every row that has a date."""
    fixed = date_attributes(F.col("date_key"))
    return dim_date.withColumns(
        {n: F.when(F.col("date_key").isNotNull(), e).otherwise(F.col(n)) for n, e in fixed.items()}
    )


def impute_date(date: Column, key: Column) -> Column:
    """A repeatable day of the fixed window for rows without a date."""
    days = bucket(key, "date", NULL_DATE_DAYS).cast("int")
    return F.coalesce(date, F.date_add(F.lit(NULL_DATE_START).cast("date"), days))
