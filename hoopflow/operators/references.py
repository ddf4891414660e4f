"""References to records that do not exist, found with compressed bitmaps.

Keys are dictionary-encoded as dense integers. A bitmap is kept sparse: one 64-bit word per (table, period, key range) that has
any bit, so an empty range costs nothing. ``reference AND NOT parent`` is one join on (period, range) and one bit operation, all
in generated code; the surviving bits are decoded through the dictionary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopflow.functions.ids import game_key, reference
from hoopflow.session import cut

WORD = 64


def no_day() -> Column:
    """The period of rows without a day: there any parent counts, whenever it was valid."""
    return F.lit("0001-01-01").cast("date")


def dense_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """Numbers distinct rows 0, 1, 2, ... without a global sort: place in the partition plus the rows of the partitions before.

    The driver sees one count per partition, never a key. The frame is materialised first, so the numbers are stable.
    """
    at = cut(df.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    counts = {r["p"]: r["n"] for r in at.groupBy(part.alias("p")).count().withColumnRenamed("count", "n").collect()}
    starts, total = [], 0
    for p in sorted(counts):
        starts.append((int(p), total))
        total += counts[p]
    offsets = at.sparkSession.createDataFrame(starts or [(0, 0)], "p long, start long")
    return (
        at.join(F.broadcast(offsets), part == F.col("p"))
        .withColumn(name, F.col("start") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_m", "p", "start")
    )


def bitmaps(bits: DataFrame, *by: str) -> DataFrame:
    """(by..., id) -> (by..., word, bits): the non-empty 64-bit words of each bitmap."""
    return bits.groupBy(*by, F.floor(F.col("id") / WORD).cast("long").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(id, {WORD}) as int))")).alias("bits")
    )


def orphans(references: DataFrame, parents: DataFrame) -> DataFrame:
    """Distinct (table_name, day, ref) of ``references`` that no row of ``parents`` covers.

    references: table_name, day, ref (normalised, not null). parents: ref, added_on, removed_on (null: still valid).
    A null ``added_on`` covers no day. Empty parents make every reference an orphan; empty references give no rows.
    """
    pairs = cut(references.select("table_name", F.coalesce("day", no_day()).alias("day"), "ref").distinct())
    known = parents.where(F.col("ref").isNotNull() & F.col("added_on").isNotNull()).select("ref", "added_on", "removed_on").distinct()
    names = dense_ids(pairs.select("ref").union(known.select("ref")).distinct())
    # A parent's bit is set on the days on which somebody refers to that name: days nobody asks for need no bit, however long a
    # period is, so a mistyped year makes no rows. A hot name is one row per day here.
    held = (F.col("added_on") <= F.col("day")) & (F.col("removed_on").isNull() | (F.col("day") < F.col("removed_on")))
    valid = pairs.select("ref", "day").distinct().join(known, "ref").where(held | (F.col("day") == no_day())).select("ref", "day")
    child = bitmaps(pairs.join(names, "ref"), "table_name", "day")
    parent = bitmaps(valid.distinct().join(names, "ref"), "day").withColumnRenamed("bits", "held")
    left = (
        child.join(parent, ["day", "word"], "left")
        .withColumn("bits", F.expr("bits & ~coalesce(held, 0L)"))
        .where("bits != 0")
    )
    decoded = left.select("table_name", "day", "word", "bits", F.explode(F.sequence(F.lit(0), F.lit(WORD - 1))).alias("bit")).where(
        "(shiftrightunsigned(bits, bit) & 1) = 1"
    )
    return decoded.withColumn("id", F.col("word") * WORD + F.col("bit")).join(names, "id").select("table_name", "day", "ref")


def game_days(header: DataFrame) -> DataFrame:
    """One day per game: the earliest of its header rows."""
    return header.groupBy(game_key(F.col("game_id")).alias("game_key")).agg(F.min("date").alias("day"))


def club_references(box: DataFrame, header: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every non-empty club reference: table_name, season_code, row_key, ref, day."""
    b = (
        box.select(
            F.lit("euroleague_box_score").alias("table_name"),
            "season_code",
            F.col("delivery_id").cast("string").alias("row_key"),
            reference(F.col("team_id")).alias("ref"),
            game_key(F.col("game_id")).alias("game_key"),
        )
        .where(F.col("ref").isNotNull())
        .join(game_days(header), "game_key", "left")
        .drop("game_key")
    )
    d = decisions.select(
        F.lit("player_name_decisions").alias("table_name"),
        "season_code",
        F.col("decision_id").alias("row_key"),
        reference(F.col("stats_team")).alias("ref"),
        F.to_date("decided_at").alias("day"),
    ).where(F.col("ref").isNotNull())
    return b.unionByName(d)


def club_names(clubs: DataFrame) -> DataFrame:
    """The three names of each club with its periods."""
    return clubs.select(
        F.explode(F.array(*[reference(F.col(c)) for c in ("code", "team", "tv")])).alias("ref"), "added_on", "removed_on"
    ).where(F.col("ref").isNotNull())


def orphan_rows(box: DataFrame, header: DataFrame, decisions: DataFrame, clubs: DataFrame) -> DataFrame:
    """table_name, season_code, row_key of each row whose club reference resolves to no club on its day.

    Null, blank and ``-`` are no references. Repeated deliveries and TOTAL rows count as rows of their own. A row whose day is
    unknown (no header, null date) resolves if any club ever had that name. Hot clubs are safe: bitmaps combine on the map side
    and the last join carries only the orphan names.
    """
    refs = club_references(box, header, decisions)
    lost = orphans(refs, club_names(clubs))
    return refs.withColumn("day", F.coalesce("day", no_day())).join(lost, ["table_name", "day", "ref"]).select("table_name", "season_code", "row_key")


def orphan_counts(box: DataFrame, header: DataFrame, decisions: DataFrame, clubs: DataFrame) -> DataFrame:
    """Orphans and references per table and season; tables and seasons without orphans show 0."""
    refs = club_references(box, header, decisions)
    total = refs.groupBy("table_name", "season_code").agg(F.count(F.lit(1)).alias("n_references"))
    lost = orphan_rows(box, header, decisions, clubs).groupBy("table_name", "season_code").agg(F.count(F.lit(1)).alias("n_orphans"))
    same = (total.table_name == lost.table_name) & total.season_code.eqNullSafe(lost.season_code)
    return total.join(lost, same, "left").select(
        total.table_name, total.season_code, "n_references", F.coalesce("n_orphans", F.lit(0)).cast("long").alias("n_orphans")
    )
