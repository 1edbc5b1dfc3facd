"""Streaming jobs: landed payloads to offers, hourly prices, alerts.

Each job is a file-source stream with a checkpoint; ``availableNow`` drains what has landed and
stops, which replaces a collector that runs every N minutes. Batches replace whole partitions,
so a restart after a lost executor or driver adds nothing twice. What a job has to remember lies in
the state store of its checkpoint or in a small keyed table of its own; no batch reads the offers' history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rentscope import schemas
from rentscope.operators.ingest import collect_run
from rentscope.operators.series import SERIES
from rentscope.operators.serving import PRICE, spread_alerts
from rentscope.plans.recency import DAY, TIERS_HOURS, hours
from rentscope.plans.saved import save
from rentscope.sources.tables import delete_path, landed_schema, list_folders, path_exists, read_payloads, with_ids

Batch = Callable[[DataFrame, int], None]


def _drain(stream: DataFrame, each: Batch, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _replace(rows: DataFrame, path: str, *parts: str) -> None:
    """Write ``rows`` in place of the partitions they belong to; others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A job's own table; empty before its first rows."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _mark(batch: DataFrame, batch_id: int) -> str:
    """Names a batch of a query; it stays the same when the batch is run again."""
    return f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}:{batch_id}"


def stream_ingest(
    spark: SparkSession, landed: str, offers: str, checkpoint: str, schema: T.StructType = schemas.PAYLOADS
) -> StreamingQuery:
    """Parse newly landed payloads into the offers table, day by day.

    A run's payloads may land in several batches. Each batch decides the runs of the days it
    touches anew, from all of their payloads that are stored, and replaces these days; ids stay
    the same. The landed folder is partitioned by day, so other days are not read.
    """

    def parse(batch: DataFrame, batch_id: int) -> None:
        days = [r[DAY] for r in batch.select(DAY).distinct().collect()]
        # The files are listed here, once: all that is read of them below sees the same payloads.
        payloads = read_payloads(spark, landed, schema).filter(F.col(DAY).isin(days))
        rows = with_ids(collect_run(payloads)).withColumn(DAY, F.to_date("captured_at"))
        _replace(rows.hint("rebalance", DAY), offers, DAY)

    return _drain(spark.readStream.schema(landed_schema(schema)).parquet(landed), parse, checkpoint)


#: A row of the stored series: what the state store had last for an hour, what came after it had let go of it, and who wrote the row.
HOURLY_STATE = T.StructType([
    *schemas.HOURLY_SERIES,
    T.StructField("open_price", T.DoubleType()), T.StructField("open_count", T.LongType()),
    T.StructField("late_price", T.DoubleType()), T.StructField("late_count", T.LongType()),
    T.StructField("batch", T.StringType()), T.StructField(DAY, T.DateType()),
])


def stream_hourly_series(offers: DataFrame, out: str, checkpoint: str, lateness: str = "2 days") -> StreamingQuery:
    """Lowest price and offers per hour, complete after every batch.

    Hours are open in the state store until the watermark, ``lateness`` behind the newest offer, has passed
    them; a batch puts their new totals in place. Offers of hours that are closed by then are dropped there: they
    are the ones of the batch without a total, and are added to the stored hour, so late offers count whenever they
    come. A batch reads its own rows, the state and the days of the series that it touches. The batch that wrote a day
    is noted in it, so that late offers of a batch that runs again are not added twice. A checkpoint belongs to its series.
    """
    priced = offers.select("captured_at", *SERIES, PRICE).filter((F.col(PRICE) > 0) & F.col("captured_at").isNotNull())
    kind = offers.schema["captured_at"].dataType
    totals = (
        priced.withWatermark("captured_at", lateness)
        .groupBy(F.window("captured_at", "1 hour").alias("hour"), *SERIES)
        .agg(F.min(PRICE).alias("price"), F.count(F.lit(1)).alias("n"))
        .select(F.col("hour.start").cast(kind).alias("captured_at"), *SERIES, "price", "n", F.lit(True).alias("is_total"))
    )
    hour = F.window("captured_at", "1 hour")["start"].cast(kind)
    rows = priced.select(hour.alias("captured_at"), *SERIES, F.col(PRICE).alias("price"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("is_total"))
    key = ["captured_at", *SERIES]
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key]

    def update(batch: DataFrame, batch_id: int) -> None:
        spark, mark = batch.sparkSession, _mark(batch, batch_id)
        total = F.col("is_total")
        summed = batch.groupBy(*key).agg(
            F.min(F.when(total, F.col("price"))).alias("new_price"), F.sum(F.when(total, F.col("n"))).alias("new_count"),
            F.min(F.when(~total, F.col("price"))).alias("row_price"), F.sum(F.when(~total, F.col("n"))).alias("row_count"),
        )
        # The batch is computed once, as the state store moves on with it.
        new = save(summed.withColumn(DAY, F.to_date("captured_at")), "hours")
        days = [r[DAY] for r in new.select(DAY).distinct().collect()]
        if not days:
            return
        before = stored(spark, out, HOURLY_STATE).filter(F.col(DAY).isin(days))
        done = [r[DAY] for r in before.filter(F.col("batch") == mark).select(DAY).distinct().collect()]
        new, before = (t.filter(~F.col(DAY).isin(done)) if done else t for t in (new, before))
        late = F.col("new_count").isNull()
        no = F.lit(0).cast("long")
        joined = new.alias("b").join(before.alias("s"), same, "full").select(
            *[F.coalesce(f"b.{k}", f"s.{k}").alias(k) for k in key],
            F.coalesce("new_price", "open_price").alias("open_price"),
            F.coalesce("new_count", "open_count", no).alias("open_count"),
            F.least("late_price", F.when(late, F.col("row_price"))).alias("late_price"),
            (F.coalesce("late_count", no) + F.coalesce(F.when(late, F.col("row_count")), no)).alias("late_count"),
            F.coalesce(f"b.{DAY}", f"s.{DAY}").alias(DAY),
        )
        made = joined.select(
            *key, F.least("open_price", "late_price").alias("price"), (F.col("open_count") + F.col("late_count")).alias("offer_count"),
            "open_price", "open_count", "late_price", "late_count", F.lit(mark).alias("batch"), DAY,
        )
        _replace(save(made, "hourly"), out, DAY)

    return _drain(totals.unionByName(rows), update, checkpoint, "update")


#: What alerts are made from: per GPU and provider the prices that no later one undercuts, and a row without price at the newest capture.
LOWEST = T.StructType([
    T.StructField("captured_at", schemas.OFFERS["captured_at"].dataType), *(schemas.OFFERS[c] for c in ("gpu_name", "provider", PRICE)),
])
#: A change of an alert: its new values, or that it has ended; ``as_of`` is the newest capture by then.
ALERT_CHANGES = T.StructType([
    *schemas.SPREAD_ALERTS, T.StructField("ended", T.BooleanType()), T.StructField("as_of", schemas.OFFERS["captured_at"].dataType),
    T.StructField("batch_id", T.LongType()), T.StructField("batch", T.StringType()), T.StructField(DAY, T.DateType()),
])


def _lowest_to_come(prices: DataFrame) -> DataFrame:
    """Rows that no later one of their GPU and provider undercuts: the lowest price since any time is that of the first of them after it.

    Rows of an hour are thinned out first, so a GPU with very many offers is spread.
    """
    kept = prices.groupBy("gpu_name", "provider", "captured_at").agg(F.min(PRICE).alias(PRICE))
    for keys in ((F.date_trunc("hour", "captured_at"),), ()):
        later = Window.partitionBy("gpu_name", "provider", *keys).orderBy(F.desc("captured_at")).rowsBetween(Window.unboundedPreceding, -1)
        lowest = F.min(PRICE).over(later)
        kept = kept.withColumn("_later", lowest).filter(F.col("_later").isNull() | (F.col(PRICE) < F.col("_later"))).drop("_later")
    return kept.select(*LOWEST.names)


def _values() -> Column:
    """An alert's values as one text, to see whether any has changed."""
    return F.to_json(F.struct(*[F.col(c) for c in schemas.SPREAD_ALERTS.names if c != "prices"], F.map_entries("prices").alias("prices")))


def stream_alerts(new_offers: DataFrame, state: str, windows: DataFrame, alerts: str, checkpoint: str) -> StreamingQuery:
    """Judge the current spreads after each batch of offers and write down what has changed.

    ``windows`` is the stored outcome of ``provider_windows``. The state holds, per GPU and provider, the prices
    that can still become the lowest of a look-back; others go when a later price undercuts them or the longest look-back has passed. Each
    batch reads the version before its own and writes the next one, so it can run again; older versions are
    removed. ``alerts`` gets a row for each new, changed or ended alert, in one folder per day of the newest capture.
    """

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark, mark = batch.sparkSession, _mark(batch, batch_id)
        versions = sorted(int(f.split("=")[1]) for f in list_folders(spark, state) if f.startswith("version="))
        before = max((v for v in versions if v < batch_id), default=None)
        then = f"{state}/version={before}"
        known = spark.createDataFrame([], LOWEST) if before is None else spark.read.schema(LOWEST).parquet(f"{then}/prices")
        seen = spark.createDataFrame([], schemas.SPREAD_ALERTS) if before is None else spark.read.schema(schemas.SPREAD_ALERTS).parquet(f"{then}/alerts")
        # The newest capture counts also where it has no price.
        rows = save(batch.select(*LOWEST.names).filter(F.col(PRICE).isNotNull()).transform(_lowest_to_come).unionByName(
            batch.select(F.max("captured_at").alias("captured_at"), *(F.lit(None).cast(LOWEST[c].dataType).alias(c) for c in LOWEST.names[1:]))
        ), "batch-prices").unionByName(known)
        as_of = rows.agg(F.max("captured_at")).first()[0]
        if as_of is None:
            return
        recent = rows.filter(F.col("captured_at") >= F.lit(as_of) - hours(TIERS_HOURS[-1]))
        clock = spark.createDataFrame([(as_of, None, None, None)], LOWEST)
        now = f"{state}/version={batch_id}"
        recent.filter(F.col(PRICE).isNotNull()).transform(_lowest_to_come).unionByName(clock).write.mode("overwrite").parquet(f"{now}/prices")
        prices = spark.read.schema(LOWEST).parquet(f"{now}/prices")
        spread_alerts(prices, windows).select(*schemas.SPREAD_ALERTS.names).write.mode("overwrite").parquet(f"{now}/alerts")
        current = spark.read.schema(schemas.SPREAD_ALERTS).parquet(f"{now}/alerts")
        old = seen.select(F.col("gpu_name").alias("of"), _values().alias("was"))
        changed = current.withColumn("is", _values()).join(old, F.col("gpu_name").eqNullSafe(F.col("of")), "left").filter(F.col("was").isNull() | (F.col("was") != F.col("is")))
        gone = seen.join(current.select(F.col("gpu_name").alias("of")), F.col("gpu_name").eqNullSafe(F.col("of")), "left_anti")
        names = schemas.SPREAD_ALERTS.names
        changes = changed.select(*names, F.lit(False).alias("ended")).unionByName(gone.select(*names, F.lit(True).alias("ended")))
        day = F.to_date(F.lit(as_of))
        changes = changes.select("*", F.lit(as_of).alias("as_of"), F.lit(batch_id).cast("long").alias("batch_id"), F.lit(mark).alias("batch"), day.alias(DAY))
        today = stored(spark, alerts, ALERT_CHANGES).filter((F.col(DAY) == day) & (F.col("batch") != mark))
        made = save(changes.unionByName(today.select(*changes.columns)), "alert-changes")
        if not made.filter(F.col("batch") == mark).isEmpty():
            _replace(made, alerts, DAY)
        for version in versions:
            if version < (batch_id if before is None else before):
                delete_path(spark, f"{state}/version={version}")

    return _drain(new_offers, judge, checkpoint)


def current_alerts(changes: DataFrame) -> DataFrame:
    """The alerts that hold after all changes: of each GPU the last one, unless it has ended."""
    names = [c for c in changes.columns if c not in ("gpu_name", "prices")]
    last = changes.groupBy("gpu_name").agg(
        F.max_by(F.struct(*names, F.map_entries("prices").alias("prices")), F.struct("as_of", "batch_id")).alias("r")
    )
    return last.filter("NOT r.ended").select(
        *[F.map_from_entries("r.prices").alias("prices") if c == "prices" else F.col("gpu_name" if c == "gpu_name" else f"r.{c}").alias(c) for c in schemas.SPREAD_ALERTS.names]
    )
