"""Totals over trailing periods, for every day, as versioned rolling state.

total(d) = total(d-1) + arrivals(d) - expiring(d-w). The recurrence is evaluated set-wise: each amount enters on its day and
leaves ``w`` days later, a running sum over these few events gives the state after each, and the days between two events share one
state, so state is kept as intervals and filled up with days last. Work before the output is proportional to the amounts.
``RollingStore`` keeps dated versions: ``advance`` starts from yesterday's totals and recomputes only the dates that arrivals and
corrections can change.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoopflow.functions.ids import key_part, message_key
from hoopflow.operators.deliveries import is_total, never, player_messages
from hoopflow.operators.references import game_days
from hoopflow.streaming.commits import CommitLog

MEASURES = ("val", "secs")


def seconds(minutes: Column) -> Column:
    """``MM:SS`` or ``M:SS`` as seconds, ``DNP`` as 0; blank, null and anything else as null."""
    m = F.trim(minutes)
    at = F.instr(m, ":")
    clock = F.substring(m, F.lit(1), at - 1).try_cast("int") * 60 + F.substring(m, at + 1, F.lit(2)).try_cast("int")
    return F.when(m.rlike(r"^\d{1,3}:\d{1,2}$"), clock).when(F.upper(m) == "DNP", F.lit(0))


def daily(rows: DataFrame, step: str = "day", *by: str) -> DataFrame:
    """Sums and non-null counts of the measures per entity and step."""
    return rows.groupBy("player_id", *by, step).agg(
        *[a for k in MEASURES for a in (F.coalesce(F.sum(k), F.lit(0)).cast("long").alias(f"{k}_sum"), F.count(k).alias(f"{k}_n"))],
        F.count(F.lit(1)).alias("games"),
    )


PARTS = [f"{k}_{p}" for k in MEASURES for p in ("sum", "n")] + ["games"]


def later(step: str, n) -> Column:
    """The step ``n`` after a row's own."""
    return F.date_add(step, n) if step == "day" else F.col(step) + n


def sums_of(windows: tuple[int, ...]) -> list[str]:
    return [f"{p}_{w}" for w in windows for p in PARTS]


def changes(amounts: DataFrame, windows: tuple[int, ...], step: str, entity: list[str]) -> DataFrame:
    """Each amount enters all windows on its step and leaves each ``w`` steps later."""

    def event(at: Column, sign: dict[int, int]) -> Column:
        return F.struct(at.alias(step), *[(F.col(p) * sign.get(w, 0)).alias(f"{p}_{w}") for w in windows for p in PARTS])

    both = F.array(event(F.col(step), {w: 1 for w in windows}), *[event(later(step, w), {w: -1}) for w in windows])
    return amounts.select(*entity, F.explode(both).alias("e")).select(*entity, "e.*")


def running(events: DataFrame, windows: tuple[int, ...], step: str, entity: list[str], end: Column | None = None) -> DataFrame:
    """entity..., step, until, sums: the state after each event, valid until the next one (the last until ``end``, or not at all)."""
    names = sums_of(windows)
    net = events.groupBy(*entity, step, *([] if end is None else ["_end"])).agg(*[F.sum(n).alias(n) for n in names])
    order = Window.partitionBy(*entity).orderBy(step)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    following = F.lead(step).over(order)
    state = net.select(*entity, step, (following if end is None else F.coalesce(following, end)).alias("until"), *[F.sum(n).over(upto).alias(n) for n in names])
    return state.where("until is not null")


def trailing_intervals(amounts: DataFrame, windows: tuple[int, ...], step: str = "day", by: tuple[str, ...] = ()) -> DataFrame:
    """The state of each entity from its first amount until its longest window has run out, as intervals [step, until).

    amounts: player_id, by..., step, and PARTS, at most one row per entity and step. One row per entity and step moves once; events, sums
    and the running window all keep this partitioning. Null entities form their own group; empty amounts give no rows.
    """
    entity = ["player_id", *by]
    return running(changes(amounts.repartition(*entity), windows, step, entity), windows, step, entity)


def expand(intervals: DataFrame, windows: tuple[int, ...], step: str = "day", by: tuple[str, ...] = ()) -> DataFrame:
    """One row per entity and step: the steps of an interval share its state."""
    steps = "sequence(day, date_sub(until, 1))" if step == "day" else f"sequence({step}, until - 1)"
    return intervals.select("player_id", *by, F.explode(F.expr(steps)).alias(step), *sums_of(windows))


def trailing_state(amounts: DataFrame, windows: tuple[int, ...], step: str = "day", by: tuple[str, ...] = ()) -> DataFrame:
    """One row per entity and step, without versions. Entities with one amount get max(windows) rows."""
    return expand(trailing_intervals(amounts, windows, step, by), windows, step, by)


def report(state: DataFrame, windows: tuple[int, ...], step: str = "day", by: tuple[str, ...] = ()) -> DataFrame:
    """Totals and averages (over the games that have the value; null where none has) of valuation and minutes."""
    out = ["player_id", *by, step]
    for w in windows:
        out += [
            F.col(f"games_{w}"),
            F.col(f"val_sum_{w}").alias(f"valuation_total_{w}"),
            F.try_divide(F.col(f"val_sum_{w}").cast("double"), F.col(f"val_n_{w}")).alias(f"valuation_avg_{w}"),
            (F.col(f"secs_sum_{w}") / 60.0).alias(f"minutes_total_{w}"),
            F.try_divide(F.col(f"secs_sum_{w}") / 60.0, F.col(f"secs_n_{w}")).alias(f"minutes_avg_{w}"),
        ]
    return state.select(*out)


def trailing_rounds(box: DataFrame, windows: tuple[int, ...] = (3, 5)) -> DataFrame:
    """The same over trailing values of ``round`` within a season, rounds without a game included."""
    m = player_messages(box, "season_code", "round", "valuation", "minutes")
    m = m.select(
        F.col("player_code").alias("player_id"), F.upper(F.trim("season_code")).alias("season_code"), F.col("round").cast("int").alias("round"),
        F.col("valuation").cast("long").alias("val"), seconds(F.col("minutes")).cast("long").alias("secs"),
    ).where(F.col("round").isNotNull())
    return report(trailing_state(daily(m, "round", "season_code"), windows, "round", ("season_code",)), windows, "round", ("season_code",))


def summed(amounts: DataFrame) -> DataFrame:
    """Amounts per player and day; corrections come as differences and may be negative."""
    return amounts.groupBy("player_id", "day").agg(*[F.sum(p).cast("long").alias(p) for p in PARTS])


def clip(intervals: DataFrame, ranges: DataFrame) -> DataFrame:
    """What is left of intervals outside their player's range [lo, hi)."""
    names = [c for c in intervals.columns if c not in ("player_id", "day", "until")]
    pieces = F.array(F.struct("day", F.least("until", "lo").alias("until")), F.struct(F.greatest("day", "hi").alias("day"), F.col("until").alias("until")))
    outside = F.filter(pieces, lambda x: x["day"] < x["until"])
    whole = F.array(F.struct("day", "until"))
    both = intervals.join(ranges, "player_id", "left").select("player_id", F.explode(F.when(F.col("lo").isNull(), whole).otherwise(outside)).alias("x"), *names)
    return both.select("player_id", "x.day", "x.until", *names)


class RollingStore:
    """Versions of the rolling state in the shared folder, as layers.

    The first layer holds all intervals. Each later one holds the intervals of the dates that its arrivals could change, for the players
    that had arrivals, and these players' ranges of dates; a version is read by laying its layers over each other. Rows of other
    players and other dates are not written again, and older versions stay readable. After ``LAYERS`` layers a version is written
    whole. A version counts once its commit record is there.
    """

    LAYERS = 8

    def __init__(self, spark: SparkSession, base: str, windows: tuple[int, ...] = (7, 30)) -> None:
        self.spark, self.base, self.windows = spark, base.rstrip("/"), windows
        self.log = CommitLog(spark, base)

    def _at(self, kind: str, version: int) -> str:
        return f"{self.base}/{kind}/v={version}"

    def _put(self, df: DataFrame, kind: str, version: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self._at(kind, version))
        return self._get(kind, version)

    def _get(self, kind: str, version: int) -> DataFrame:
        return self.spark.read.parquet(self._at(kind, version))

    def versions(self) -> list[int]:
        return self.log.versions()

    def state(self, version: int | None = None) -> DataFrame:
        """player_id, day, until, sums of a version (the newest if none is named)."""
        first, *layers = self.log.record(self.versions()[-1] if version is None else version)["layers"]
        out = self._get("state", first)
        for v in layers:
            out = clip(out, self._get("ranges", v)).unionByName(self._get("state", v))
        return out

    def amounts(self, version: int | None = None) -> DataFrame:
        """The daily amounts a version has counted, corrections included."""
        layers = self.log.record(self.versions()[-1] if version is None else version)["layers"]
        return summed(self.spark.read.parquet(*[self._at("amounts", v) for v in layers])).where("games != 0")

    def build(self, amounts: DataFrame) -> None:
        """Version 0 from everything counted so far."""
        kept = self._put(amounts.select("player_id", "day", *PARTS), "amounts", 0)
        self._put(trailing_intervals(kept, self.windows), "state", 0)
        self.log.commit(0, {"layers": [0]})

    def advance(self, arrivals: DataFrame) -> int:
        """The next version: yesterday's totals, plus what arrived, minus what expires, for the dates that arrivals can change.

        arrivals: player_id, day, PARTS; a correction is the difference to what was counted. A player's range starts at the first changed
        day and ends when the last changed day leaves the longest window; it reaches further where a first or last game comes or goes,
        since the days between belong to the player's span or don't any more. The totals of the day before the range are taken from
        the last version. Empty arrivals make a version that equals the one before.
        """
        version, longest, names = self.versions()[-1] + 1, max(self.windows), sums_of(self.windows)
        layers = self.log.record(version - 1)["layers"]
        changed = self._put(summed(arrivals), "amounts", version)
        touched = changed.groupBy("player_id").agg(F.min("day").alias("from"), F.max("day").alias("to"))
        before = self.state(version - 1).join(touched.select("player_id"), "player_id", "left_semi")
        counted = self.spark.read.parquet(*[self._at("amounts", v) for v in [*layers, version]]).join(touched.select("player_id"), "player_id", "left_semi")
        after = summed(counted).where("games != 0")
        old = before.groupBy("player_id").agg(F.min("day").alias("first0"), F.max("until").alias("end0"))
        new = after.groupBy("player_id").agg(F.min("day").alias("first1"), F.date_add(F.max("day"), longest).alias("end1"))
        span = touched.join(old, "player_id", "left").join(new, "player_id", "left")
        lo, hi = F.least("from", "end0", "end1"), F.greatest(F.date_add("to", longest), "first0", "first1", F.when(F.col("end1").isNull(), F.col("end0")))
        ranges = self._put(span.select("player_id", lo.alias("lo"), hi.alias("hi"), "first1", "end1"), "ranges", version)
        own = ranges.select("player_id", "lo", F.col("hi").alias("_end"))
        yesterday = before.join(own, "player_id").where("day < lo and until >= lo").select("player_id", F.col("lo").alias("day"), "_end", *names)
        start = own.select("player_id", F.col("lo").alias("day"), "_end", *[F.lit(0).cast("long").alias(n) for n in names])
        moves = changes(after, self.windows, "day", ["player_id"]).join(own, "player_id").where("day >= lo and day < _end").select("player_id", "day", "_end", *names)
        fresh = running(yesterday.unionByName(start).unionByName(moves), self.windows, "day", ["player_id"], F.col("_end")).join(ranges.select("player_id", "first1", "end1"), "player_id")
        fresh = fresh.withColumn("day", F.greatest("day", "first1")).withColumn("until", F.least("until", "end1")).where("end1 is not null and day < until")
        self._put(fresh.select("player_id", "day", "until", *names), "state", version)
        self.log.commit(version, {"layers": [*layers, version]})
        if len(layers) >= self.LAYERS:
            self._whole(version)
        return version

    def _whole(self, version: int) -> None:
        """Writes a version as one layer, under a number of its own, and lets its record name that one."""
        own = -version
        self._put(self.state(version), "state", own)
        self._put(self.amounts(version), "amounts", own)
        self.log.commit(version, {"layers": [own]})


def packed(code: Column) -> Column:
    """A row's figures in one number: whether it is a club's row, valuation and seconds, each with whether it is there."""
    val, secs = F.col("valuation").cast("long"), seconds(F.col("minutes")).cast("long")
    parts = [
        F.shiftleft(is_total(code, F.col("dorsal"), F.col("game")).cast("long"), 60), F.shiftleft(val.isNotNull().cast("long"), 59), F.shiftleft(F.coalesce(val + (1 << 31), F.lit(0)).cast("long"), 26),
        F.shiftleft(secs.isNotNull().cast("long"), 25), F.coalesce(secs, F.lit(0)).cast("long"),
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def unpacked(x: Column) -> tuple[Column, Column, Column]:
    """total, valuation, seconds of a packed row."""
    bit = lambda n: F.shiftright(x, n).bitwiseAND(F.lit(1)) == 1
    val = F.shiftright(x, 26).bitwiseAND(F.lit((1 << 32) - 1)) - (1 << 31)
    return bit(60), F.when(bit(59), val), F.when(bit(25), x.bitwiseAND(F.lit((1 << 25) - 1)))


def versioned_amounts(box: DataFrame, header: DataFrame, edges: list) -> DataFrame:
    """version, player_id, day, PARTS: what each stretch of loading time adds to, or corrects in, the daily amounts.

    ``edges`` are loading times; version k knows the deliveries loaded up to the k-th. A message counts with its first delivery; one
    that a later version replaces is taken back there. One aggregate per message gives all versions.
    """
    at = F.coalesce(F.col("loaded_at").cast("timestamp_ntz"), never())
    known = [F.lit(True) if e is None else at <= F.lit(e).cast("timestamp_ntz") for e in [*edges, None]]
    # Order and values are numbers of fixed size, so the aggregate is hashed, not sorted: loading time and delivery number; and the
    # row's figures, packed.
    order = F.unix_micros(at.cast("timestamp")).cast("decimal(19,0)") * F.expr("10000000000000000000BD") + F.coalesce(F.col("delivery_id").cast("long"), F.lit((1 << 63) - 1)).cast("decimal(19,0)")
    message = message_key(F.col("game_player_id"))
    one = box.where(F.col("game_player_id").isNotNull()).select(message.alias("message"), order.cast("decimal(38,0)").alias("o"), packed(key_part(message, 3)).alias("x"), *[k.alias(f"k{i}") for i, k in enumerate(known)])
    seen = [F.when(F.col(f"k{i}"), F.col("o")) for i in range(len(known))]
    rows = one.groupBy("message").agg(*[c for i, o in enumerate(seen) for c in (F.min(o).alias(f"o{i}"), F.min_by("x", o).alias(f"v{i}"))])

    def entry(i: int, j: int, sign: int) -> Column:
        return F.struct(F.lit(i).alias("version"), F.lit(sign).alias("sign"), F.col(f"v{j}").alias("x"))

    steps = [F.when(F.col("o0").isNotNull(), entry(0, 0, 1))]
    for i in range(1, len(known)):
        moved = ~F.col(f"o{i}").eqNullSafe(F.col(f"o{i - 1}"))
        steps += [F.when(moved & F.col(f"o{i - 1}").isNotNull(), entry(i, i - 1, -1)), F.when(moved, entry(i, i, 1))]
    rows = rows.select("message", F.explode(F.filter(F.array(*steps), lambda s: s.isNotNull())).alias("s")).select("message", "s.version", "s.sign", "s.x")
    total, val, secs = unpacked(F.col("x"))
    rows = rows.select("version", "sign", key_part(F.col("message"), 3).alias("player_id"), F.concat_ws("_", key_part(F.col("message"), 1), key_part(F.col("message"), 2)).alias("game_key"), total.alias("total"), val.alias("val"), secs.alias("secs"))
    rows = rows.where(F.col("player_id").isNotNull() & ~F.col("total"))
    rows = rows.join(game_days(header), "game_key").where(F.col("day").isNotNull())
    signed = [a for k in MEASURES for a in (F.coalesce(F.sum(F.col(k) * F.col("sign")), F.lit(0)).cast("long").alias(f"{k}_sum"), F.coalesce(F.sum(F.when(F.col(k).isNotNull(), F.col("sign"))), F.lit(0)).cast("long").alias(f"{k}_n"))]
    return rows.groupBy("player_id", "version", "day").agg(*signed, F.sum("sign").cast("long").alias("games"))


def loading_edges(box: DataFrame, shares: tuple[float, ...]) -> list:
    """The loading times up to which these shares of the rows had come."""
    micros = F.unix_micros(F.col("loaded_at").cast("timestamp"))
    found = box.agg(F.percentile_approx(micros, list(shares), 1000).alias("e")).first()["e"] if shares else None
    return [r[0] for r in box.sparkSession.range(1).select(F.explode(F.array(*[F.timestamp_micros(F.lit(e)).cast("timestamp_ntz") for e in found]))).collect()] if found else []


def last_days(box: DataFrame, days: int) -> list:
    """The loading time that many days before the last one."""
    last = box.agg(F.max("loaded_at").alias("t")).first()["t"]
    return [last - timedelta(days=days)] if last else []


def build_versions(box: DataFrame, header: DataFrame, base: str, edges: list, windows: tuple[int, ...] = (7, 30)) -> RollingStore:
    """A store with a version for the deliveries loaded up to each of the edges, and one for all of them."""
    spark = box.sparkSession
    store = RollingStore(spark, base, windows)
    parts = versioned_amounts(box, header, edges)
    if edges:
        parts.write.mode("overwrite").partitionBy("version").parquet(f"{store.base}/arrivals")
        parts = spark.read.schema("player_id string, day date, " + ", ".join(f"{p} long" for p in PARTS) + ", version int").parquet(f"{store.base}/arrivals")
    store.build(parts.where("version = 0"))
    for i in range(1, len(edges) + 1):
        store.advance(parts.where(f"version = {i}"))
    return store


def trailing_days(box: DataFrame, header: DataFrame, base: str, shares: tuple[float, ...] | None = None, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """The report of the newest version. Without ``shares`` the version before it holds all but the arrivals of the last 30 days."""
    edges = last_days(box, 30) if shares is None else loading_edges(box, shares)
    return report(expand(build_versions(box, header, base, edges, windows).state(), windows), windows)
