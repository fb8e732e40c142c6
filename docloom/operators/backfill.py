"""Derived columns of stored points: court ids and decision dates, written only where they change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as X

#: The classes of a backfill's rows; every row is in one.
CLASSES = ["updated", "already_correct", "missing_or_invalid"]


def court_ids(df: DataFrame, file_name: str = "file_name", case_id: str = "case_id", stored: str = "court_id") -> DataFrame:
    """Adds ``computed`` and ``class``. A stored number may also be text."""
    computed = X.court_id(F.coalesce(F.col(file_name).cast("string"), F.col(case_id).cast("string")))
    return _classified(df.withColumn("computed", computed), F.col("computed").eqNullSafe(X.existing_number(stored)))


def decision_dates(df: DataFrame, text: str = "date_of_decision", date: str = "decision_date", year: str = "decision_year") -> DataFrame:
    """Adds ``computed`` (a struct of date and year) and ``class``; a stored date is an ISO text or a date."""
    df = df.withColumn("docloom_parsed", X.decision_date(text))
    both = F.when(F.col("docloom_parsed.decision_date").isNotNull(), F.col("docloom_parsed"))
    same = F.date_format("docloom_parsed.decision_date", "yyyy-MM-dd").eqNullSafe(F.col(date).cast("string")) & F.col("docloom_parsed.decision_year").cast("long").eqNullSafe(X.existing_number(year))
    return _classified(df.withColumn("computed", both), same).drop("docloom_parsed")


def _classified(df: DataFrame, same: Column) -> DataFrame:
    return df.withColumn("class", F.when(F.col("computed").isNull(), CLASSES[2]).when(same, CLASSES[1]).otherwise(CLASSES[0]))


def applied(df: DataFrame, stored: str = "court_id") -> DataFrame:
    """The table after a court-id backfill: invalid rows keep what they had."""
    return df.withColumn(stored, F.when(F.col("class") == CLASSES[0], F.col("computed")).otherwise(X.existing_number(stored))).drop("computed", "class")


def summary(df: DataFrame) -> DataFrame:
    """``scanned`` and the rows of every class, in one aggregation."""
    return df.agg(F.count("*").alias("scanned"), *[F.count_if(F.col("class") == c).alias(c) for c in CLASSES])


def groups(df: DataFrame) -> DataFrame:
    """Rows to write by computed value."""
    return df.where(F.col("class") == CLASSES[0]).groupBy("computed").agg(F.count("*").alias("points"))


def samples(df: DataFrame, key: str, rows: int = 20) -> DataFrame:
    """The first rows by key whose value can't be computed."""
    return df.where(F.col("class") == CLASSES[2]).orderBy(key).limit(rows)
