"""Checks that gate every written table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLES = 10


class DataQualityError(ValueError):
    """A table breaks its contract; the message names the rows."""


def blank_row(df: DataFrame, *of: str) -> Column:
    """All cells (or those of the columns ``of``) null or blank text."""
    return F.forall(F.array(*[F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in of or df.columns]), lambda x: x == "")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """key columns as text and ``n`` of keys that occur more than once; blank rows don't count."""
    return df.where(~blank_row(df)).groupBy(*[F.col(k).cast("string").alias(k) for k in key]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def blank_rows(df: DataFrame, *of: str) -> DataFrame:
    return df.where(blank_row(df, *of))


def validate(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """The frame itself if it has no blank rows, all key columns and unique keys; else an error that reports everything at once."""
    missing = [k for k in key if k not in df.columns]
    problems = [f"missing key column(s) {missing}"] if missing else []
    blanks = blank_rows(df).count()
    if blanks:
        problems.append(f"{blanks} blank row(s)")
    if not missing:
        twice = duplicate_keys(df, key).orderBy(*key).limit(SAMPLES + 1).collect()
        if twice:
            shown = ", ".join(f"{'|'.join(str(r[k]) for k in key)} ({r['n']}x)" for r in twice[:SAMPLES])
            problems.append(f"duplicate key {key}: {shown}{', ...' if len(twice) > SAMPLES else ''}")
    if problems:
        raise DataQualityError(f"{name}: {'; '.join(problems)}")
    return df
