"""Customer segmentation kept up date by date: what a batch touches is read, not the whole fact.

Stored below one root:

- ``days``: purchases summed per date, session and user, partitioned by date;
- ``users``: last order, purchase sessions and money spent of every buyer, in buckets;
- ``counts``: how many users have each value of each metric, partitioned by metric and range of values;
- ``pending``: the partitions that a running update is about to replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlens.operators.merge import touched_partitions
from basketlens.plans import rfm
from basketlens.session import make_folder, path_exists, remove_path
from basketlens.sources.writers import ensure_path, put_partitions

_MONEY = "decimal(38,6)"  # exact, so that a sum does not depend on the order of the batches
_SUMS = f"LAST_ORDER TIMESTAMP, N LONG, SPENT {_MONEY}"
_TABLES = {
    "days": (f"USER_SESSION STRING, USER_ID STRING, {_SUMS}, DAY STRING", ["DAY"]),
    "users": (f"USER_ID STRING, {_SUMS}, BUCKET INT", ["BUCKET"]),
    "counts": ("VALUE DECIMAL(38,2), N LONG, METRIC STRING, BIN INT", ["METRIC", "BIN"]),
}


def day_totals(events: DataFrame) -> DataFrame:
    """Purchases per date, session and user: last one, number, money. A missing price adds nothing."""
    money = F.sum(F.col("PRICE").cast("decimal(20,6)"))
    return (
        events.where(F.col("EVENT_TYPE") == "purchase")
        .groupBy("USER_SESSION", "USER_ID", F.col("EVENT_DATE").alias("DAY"))
        .agg(
            F.max("EVENT_DATETIME").alias("LAST_ORDER"),
            F.count(F.lit(1)).alias("N"),
            F.coalesce(money, F.lit(0)).cast(_MONEY).alias("SPENT"),
        )
    )


def _baskets(rows: DataFrame) -> DataFrame:
    """Buyer, last order and money of every session in rows of ``days``."""
    per_user = rows.groupBy("USER_SESSION", "USER_ID").agg(
        F.max("LAST_ORDER").alias("DATETIME_ORDER"),
        F.sum("N").alias("QUANTITY"),
        F.sum("SPENT").cast(_MONEY).alias("SPENT_MONEY"),
    )
    basket = F.struct("USER_ID", F.col("DATETIME_ORDER").alias("LAST_ORDER"), F.col("SPENT_MONEY").cast(_MONEY).alias("SPENT"))
    return rfm.baskets_of(per_user).select("USER_SESSION", basket.alias("basket"))


def _within(rows: DataFrame, found: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """Rows whose ``column`` occurs in ``found`` (or does not, by ``how``), NULLs equal."""
    return rows.alias("l").join(found.alias("r"), F.col(f"l.{column}").eqNullSafe(F.col(f"r.{column}")), how)


def _differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that occur on one side only, or not equally often on both; NULLs equal. One pass over either side."""
    sides = old.withColumn("__side", F.lit(-1)).unionByName(new.withColumn("__side", F.lit(1)))
    return sides.groupBy(*old.columns).agg(F.sum("__side").alias("__more")).where("__more <> 0").drop("__more")


def _values() -> Column:
    """The three metrics of a user. Recency grows as the day of the last order falls, whatever the study date."""
    values = {
        "RECENCY": -F.unix_date(F.col("LAST_ORDER").cast("date")),
        "FREQUENCY": F.col("N"),
        "MONETARY": F.col("SPENT").cast("decimal(30,2)"),
    }
    return F.array(
        *[F.struct(F.lit(m).alias("METRIC"), v.cast("decimal(38,2)").alias("VALUE")) for m, v in values.items()]
    )


def _bin() -> Column:
    """Sixteen ranges of values per doubling, in the order of the values."""
    value = F.col("VALUE").cast("double")
    return (F.signum(value) * F.floor(F.log2(1 + F.abs(value)) * 16)).cast("int")


class Segments:
    """Sessions, users and value counts below ``root``, brought up to date by the dates a batch touches.

    An update first writes every partition that is going to change, then replaces them; if it is
    stopped in between, the next one finishes it before it starts. To repeat an update, with the
    same rows or with rows that were delivered late, changes nothing but what differs.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        for name, (ddl, parts) in _TABLES.items():
            ensure_path(spark, StructType.fromDDL(ddl), f"{self.root}/{name}", parts)
        self._finish()

    def table(self, name: str) -> DataFrame:
        return self._read(f"{self.root}/{name}", _TABLES[name][0])

    def _read(self, path: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def _pending(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/pending/{name}"
        df.write.mode("overwrite").parquet(path)
        return self._read(path, df.schema)

    def _finish(self) -> None:
        """Replace what a completely prepared update is about to change; drop half of a preparation."""
        pending = f"{self.root}/pending"
        if path_exists(self.spark, f"{pending}/complete"):
            for name, (ddl, parts) in _TABLES.items():
                put_partitions(self._read(f"{pending}/{name}", ddl), f"{self.root}/{name}", parts)
        remove_path(self.spark, pending)

    def update(self, events: DataFrame, dates: DataFrame) -> None:
        """Take over the fact's rows of some dates.

        ``events`` has all rows of the fact on ``dates`` (a column EVENT_DATE), rows of other dates are
        ignored. Dates without a purchase any more are emptied.
        """
        self._finish()
        self._prepare(events, dates)
        make_folder(self.spark, f"{self.root}/pending/complete")
        self._finish()

    def _prepare(self, events: DataFrame, dates: DataFrame) -> None:
        touched = self._pending("touched", dates.select(F.col("EVENT_DATE").cast("string").alias("DAY")).distinct())
        ours = events.withColumn("EVENT_DATE", F.col("EVENT_DATE").cast("string"))
        fresh = day_totals(touched_partitions(ours, touched.withColumnRenamed("DAY", "EVENT_DATE"), ["EVENT_DATE"]))
        columns = self.table("days").columns
        # a date left without purchases still needs a row, or its partition would not be replaced
        empty = touched.select(
            F.lit(None).cast("string").alias("USER_SESSION"), F.lit(None).cast("string").alias("USER_ID"),
            F.lit(None).cast("timestamp").alias("LAST_ORDER"), F.lit(0).cast("long").alias("N"),
            F.lit(0).cast(_MONEY).alias("SPENT"), "DAY",
        )
        new = self._pending("days", fresh.select(*columns).unionByName(empty)).where("N > 0")
        days = self.table("days").where("N > 0")
        old = touched_partitions(days, touched, ["DAY"])
        others = _within(days, touched, "DAY", "left_anti")
        sessions = self._pending("sessions", _differing(old, new).select("USER_SESSION").distinct())
        rest = self._pending("rest", _within(others, sessions, "USER_SESSION"))
        before = _baskets(rest.unionByName(_within(old, sessions, "USER_SESSION")))
        after = _baskets(rest.unionByName(_within(new, sessions, "USER_SESSION")))
        moves = before.withColumnRenamed("basket", "was").alias("l").join(
            after.withColumnRenamed("basket", "now").alias("r"),
            F.col("l.USER_SESSION").eqNullSafe(F.col("r.USER_SESSION")), "full",
        )
        both = F.coalesce("l.USER_SESSION", "r.USER_SESSION").alias("USER_SESSION")
        moves = self._pending("moves", moves.select(both, "was", "now").where(~F.col("was").eqNullSafe(F.col("now"))))
        changed = self._pending("changed", self._changed_users(moves, others.unionByName(new), rest.unionByName(old)))
        self._pending("users", self._user_partitions(changed))
        self._pending("counts", self._count_partitions(changed))

    def _changed_users(self, moves: DataFrame, state: DataFrame, former: DataFrame) -> DataFrame:
        """Buyers with other totals than before: the stored and the new ones side by side.

        Sessions and money are added and taken away. The last order of a buyer who loses a session, or
        whose session ends earlier now, is looked up among that buyer's sessions in ``state``.
        """
        parts = [
            moves.where(f"{side} is not null").select(
                f"{side}.USER_ID",
                F.lit(sign).alias("N"),
                (F.col(f"{side}.SPENT") * sign).cast(_MONEY).alias("SPENT"),
                F.col(f"{side}.LAST_ORDER" if sign > 0 else "was.LAST_ORDER").alias("LAST_ORDER"),
                F.lit(sign > 0).alias("IS_NEW"),
            )
            for side, sign in (("was", -1), ("now", 1))
        ]
        delta = parts[0].unionByName(parts[1]).groupBy("USER_ID").agg(
            F.sum("N").alias("dN"),
            F.sum("SPENT").cast(_MONEY).alias("dSPENT"),
            F.max(F.when(F.col("IS_NEW"), F.col("LAST_ORDER"))).alias("NEWEST"),
        )
        same = F.col("now.USER_ID").eqNullSafe(F.col("was.USER_ID")) & (F.col("now.LAST_ORDER") >= F.col("was.LAST_ORDER"))
        lost = moves.where(F.col("was").isNotNull() & ~F.coalesce(same, F.lit(False)))
        losers = lost.select("was.USER_ID").distinct()
        # every session of such a buyer, alone or composite, holds a user of the session that is gone
        members = _within(former, lost.select("USER_SESSION"), "USER_SESSION").select("USER_ID").distinct()
        own = _within(state, members, "USER_ID").select("USER_SESSION").distinct()
        anew = _baskets(_within(state, own, "USER_SESSION")).select("basket.USER_ID", "basket.LAST_ORDER")
        anew = anew.groupBy("USER_ID").agg(F.max("LAST_ORDER").alias("ANEW"))
        lookup = losers.withColumn("LOST", F.lit(True)).join(anew, "USER_ID", "left")
        known = self.table("users").select("USER_ID", F.struct("LAST_ORDER", "N", "SPENT").alias("was"))
        joined = delta.join(lookup, "USER_ID", "left").join(known, "USER_ID", "left")
        last = F.when(F.col("LOST"), F.col("ANEW")).otherwise(F.greatest("was.LAST_ORDER", "NEWEST"))
        return joined.select(
            "USER_ID",
            "was",
            last.alias("LAST_ORDER"),
            (F.coalesce("was.N", F.lit(0)) + F.col("dN")).cast("long").alias("N"),
            (F.coalesce("was.SPENT", F.lit(0)) + F.col("dSPENT")).cast(_MONEY).alias("SPENT"),
            F.pmod(F.xxhash64("USER_ID"), F.lit(self.buckets)).cast("int").alias("BUCKET"),
        )

    def _user_partitions(self, changed: DataFrame) -> DataFrame:
        users = touched_partitions(self.table("users"), changed, ["BUCKET"])
        return users.join(changed.select("USER_ID"), "USER_ID", "left_anti").unionByName(changed.drop("was"))

    def _count_partitions(self, changed: DataFrame) -> DataFrame:
        was = changed.where("was.N > 0").select("was.*").select(F.inline(_values())).withColumn("N", F.lit(-1))
        now = changed.where("N > 0").select(F.inline(_values())).withColumn("N", F.lit(1))
        delta = was.unionByName(now).groupBy("METRIC", "VALUE").agg(F.sum("N").alias("N")).where("N <> 0")
        delta = self._pending("delta", delta.withColumn("BIN", _bin()))
        counts = touched_partitions(self.table("counts"), delta, ["METRIC", "BIN"])
        kept = delta.select("METRIC", "BIN").distinct().withColumns({"VALUE": F.lit(None), "N": F.lit(0)})  # as for empty dates
        summed = counts.unionByName(delta).unionByName(kept).groupBy("METRIC", "BIN", "VALUE").agg(F.sum("N").alias("N"))
        return summed.where("N <> 0 or VALUE is null").select(*self.table("counts").columns)

    def totals(self) -> DataFrame:
        """Last order, purchase sessions and money spent of every buyer."""
        money = F.col("SPENT").cast("decimal(30,2)").alias("MONETARY")
        return self.table("users").where("N > 0").select("USER_ID", "LAST_ORDER", F.col("N").alias("FREQUENCY"), money)

    def quartiles(self) -> DataFrame:
        """The exact quartile cuts, one row: totals of the ranges say which of them hold a cut, only these are ordered."""
        counts = self.table("counts").where("VALUE is not null")
        upto = Window.partitionBy("METRIC").orderBy("BIN")
        bins = counts.groupBy("METRIC", "BIN").agg(F.sum("N").alias("N")).withColumns(
            {"UPTO": F.sum("N").over(upto), "ALL": F.sum("N").over(Window.partitionBy("METRIC"))}
        )
        ranks = F.posexplode(F.array(*map(F.lit, rfm.QUARTILES))).alias("i", "p")
        need = F.ceil(F.col("p") * F.col("ALL")) - F.col("UPTO") + F.col("N")
        wanted = bins.select("METRIC", "BIN", "N", "UPTO", "ALL", ranks).withColumn("NEED", need)
        wanted = wanted.where("NEED > 0 and NEED <= N").select("METRIC", "BIN", "i", "NEED")  # three rows a metric
        inside = counts.join(F.broadcast(wanted), ["METRIC", "BIN"])
        covered = F.sum("N").over(Window.partitionBy("METRIC", "i").orderBy("VALUE"))
        cuts = inside.withColumn("COVERED", covered).where("COVERED >= NEED").groupBy("METRIC", "i").agg(F.min("VALUE").alias("VALUE"))
        newest = counts.where("METRIC = 'RECENCY'").agg(F.min("VALUE")).scalar()
        value = F.when(F.col("METRIC") == "RECENCY", F.col("VALUE") - newest + 1).otherwise(F.col("VALUE")).cast("double")
        pick = lambda m, i: F.max(F.when((F.col("METRIC") == m) & (F.col("i") == i), value))
        return cuts.agg(*[F.array(*[pick(m, i) for i in range(len(rfm.QUARTILES))]).alias(m) for m in rfm.METRICS])

    def rfm(self, etl_ts: str) -> DataFrame:
        """The segmentation of all buyers as it stands, equal to ``rfm.rfm`` over the whole fact."""
        return rfm.segments(rfm.user_values(self.totals()), self.quartiles(), etl_ts)
