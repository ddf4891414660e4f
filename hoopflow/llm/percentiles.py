"""Percentiles of very large numeric columns by radix selection.

A floating value becomes a 64-bit integer of the same order. A pass histograms the next 16 bits of the values that share the digits
found so far and follows only the digit that holds each target rank; four passes give the exact value, fewer give a value whose
relative error is bounded (``prefix_state``: at most 2**-(bits - 12)). Histograms of separate seasons or batches add up.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from hoopflow.session import cut

DIGIT, BITS = 16, 64
#: thousandths, so ranks are whole-number arithmetic
TARGETS = (100, 250, 500, 750, 900, 990)
NULL_GROUP = "\u0000"


@F.pandas_udf(LongType())
def ordered_bits(values: pd.Series) -> pd.Series:
    """Order-preserving integers: -0.0 is 0.0, infinities are the extremes, null and NaN give null."""
    missing = values.isna().to_numpy()
    bits = (np.nan_to_num(values.to_numpy(dtype="float64", na_value=0.0), nan=0.0, posinf=np.inf, neginf=-np.inf) + 0.0).view("int64")
    out = pd.Series(bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).astype("Int64")
    out[missing] = pd.NA
    return out


@F.pandas_udf(DoubleType())
def value_of_bits(bits: pd.Series) -> pd.Series:
    b = bits.to_numpy(dtype="int64")
    return pd.Series((b ^ ((b >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view("float64"))


def value_counts(df: DataFrame, groups: dict[str, Column], value: Column) -> DataFrame:
    """level, grp, u, n: each distinct value of each group with its count, combined on the map side before any shuffle.

    ``groups`` names the levels; a row counts once in each. Null groups are kept as a group; null and NaN values are not counted.
    """
    level = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.coalesce(g.cast("string"), F.lit(NULL_GROUP)).alias("grp")) for k, g in groups.items()]))
    counted = df.select(value.cast("double").alias("v"), level.alias("g")).where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("g.level", "g.grp", "v").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("level", "grp", ordered_bits("v").alias("u"), "n")


def _follow(hist: DataFrame, targets: DataFrame) -> DataFrame:
    """Moves each target into the prefix that holds its rank. hist: level, grp, parent, prefix, n. targets: level, grp, q, rank, prefix."""
    order = Window.partitionBy("level", "grp", "parent").orderBy("prefix")
    cum = hist.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    t = targets.withColumnRenamed("prefix", "parent")
    return (
        t.join(cum, ["level", "grp", "parent"])
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        .select("level", "grp", "total", "q", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "prefix")
    )


def select_ranks(counts: DataFrame, targets: tuple[int, ...] = TARGETS, bits: int = BITS, width: int = BITS) -> DataFrame:
    """level, grp, total, q, prefix: the first ``bits`` bits of the value at each target rank, ceil(q/1000 * total), at least 1.

    counts: level, grp, u, n with u of ``width`` bits. Ties share a value; an empty table gives no rows.
    """
    total = counts.groupBy("level", "grp").agg(F.sum("n").alias("total"))
    found = total.select(
        "level", "grp", "total", F.explode(F.array(*[F.lit(q) for q in targets])).alias("q"), F.lit(None).cast("long").alias("prefix")
    ).withColumn("rank", F.greatest(F.lit(1), F.expr("(q * total + 999) div 1000")))
    found = found.withColumn("prefix", F.lit(0).cast("long"))
    done = 0
    while done < bits:
        step = min(DIGIT, bits - done)
        here = counts.withColumn("prefix", F.shiftright("u", width - done - step))
        parent = F.shiftright("prefix", step) if done else F.lit(0).cast("long")
        here = here.withColumn("parent", parent)
        if done:  # only the values under a digit that holds a target
            here = here.join(found.select("level", "grp", F.col("prefix").alias("parent")).distinct(), ["level", "grp", "parent"], "left_semi")
        found = _follow(here.groupBy("level", "grp", "parent", "prefix").agg(F.sum("n").alias("n")), found)
        done += step
    return found


def percentiles(df: DataFrame, groups: dict[str, Column], value: Column, targets: tuple[int, ...] = TARGETS) -> DataFrame:
    """level, grp, n and p<q> for each target: exact values (the smallest value with at least that share at or below it)."""
    found = select_ranks(cut(value_counts(df, groups, value)), targets)
    return _wide(found.withColumn("value", value_of_bits("prefix")), targets)


def _wide(found: DataFrame, targets: tuple[int, ...]) -> DataFrame:
    wide = found.groupBy("level", "grp").agg(F.first("total").alias("n"), *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"p{q}") for q in targets])
    return wide.withColumn("grp", F.when(F.col("grp") != NULL_GROUP, F.col("grp")))


def prefix_state(df: DataFrame, groups: dict[str, Column], value: Column, part: Column, bits: int = 32) -> DataFrame:
    """The mergeable form: level, grp, part, prefix, n, where ``part`` is a season, day or batch. States of parts are added by ``merge``."""
    if not 13 <= bits <= BITS:
        raise ValueError("bits must lie between 13 and 64")
    parts = {k: F.to_json(F.struct(g.cast("string").alias("g"), part.cast("string").alias("p"))) for k, g in groups.items()}
    c = value_counts(df, parts, value)
    return (
        c.groupBy("level", F.from_json("grp", "g string, p string").alias("k"), F.shiftright("u", BITS - bits).alias("prefix"))
        .agg(F.sum("n").alias("n"))
        .select("level", F.coalesce("k.g", F.lit(NULL_GROUP)).alias("grp"), F.col("k.p").alias("part"), "prefix", "n")
    )


def merge(state: DataFrame, targets: tuple[int, ...] = TARGETS, bits: int = 32) -> DataFrame:
    """Percentiles over all parts of a state; each lies within 2**-(bits - 12) of the exact value, relative to it."""
    counts = cut(state.groupBy("level", "grp", F.col("prefix").alias("u")).agg(F.sum("n").alias("n")))
    found = select_ranks(counts, targets, bits, bits)
    # Of the values that share a prefix, the one nearest to zero: whole numbers of up to bits - 12 digits come out exactly.
    nearest = F.shiftleft("prefix", BITS - bits) + F.when(F.col("prefix") < 0, (1 << (BITS - bits)) - 1).otherwise(0)
    return _wide(found.withColumn("value", value_of_bits(nearest)), targets)


def box_groups() -> dict[str, Column]:
    club = F.upper(F.regexp_replace("team_id", r"^[\s\u00a0]+|[\s\u00a0]+$", ""))
    return {"player": F.col("player"), "club_season": F.concat_ws("|", F.coalesce(club, F.lit("")), "season_code")}


def person_rows(box: DataFrame) -> DataFrame:
    """Rows of persons: all but those marked TOTAL. Repeated deliveries count as they stand."""
    return box.where(F.coalesce(F.upper(F.trim("dorsal")) != "TOTAL", F.lit(True)))
