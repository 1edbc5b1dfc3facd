"""Files in and out: offers, JSON windows, spot-price archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentscope import schemas
from rentscope.plans.recency import DAY
from rentscope.sources import archives


#: Distinct runs that a row group's Bloom filter is sized for, and bytes of a row group.
RUNS_IN_GROUP, ROW_GROUP = 2_000, 32 << 20


def with_ids(offers: DataFrame) -> DataFrame:
    """Rows with an ``id``: a 64-bit hash of what tells offers of a run apart.

    Rows that agree in all of it are numbered in the order of their other columns, so a batch
    that is collected again gets the same ids. Rows that carry an id keep it.
    """
    if "id" in offers.columns:
        return offers
    told = ["snapshot_id", "provider", "offer_id", "interruptible", "price_per_gpu_hr"]
    rest = [c for c in offers.columns if c not in told]
    turn = F.row_number().over(Window.partitionBy(*told).orderBy(F.xxhash64(*rest), *rest))
    return offers.withColumn("_turn", turn).select(F.xxhash64(*told, "_turn").alias("id"), *offers.columns)


def append_offers(offers: DataFrame, path: str) -> None:
    """Append offers, partitioned by capture day and sorted for min/max skipping.

    Rows without ids get theirs here. The rebalance hint lets adaptive execution split a heavy
    day over several files and merge light days into few. A Bloom filter per row group tells which of
    them can hold a run, so that a run is found without its day, and without reading what cannot hold it.
    """
    (
        with_ids(offers).withColumn(DAY, F.to_date("captured_at"))
        .hint("rebalance", DAY)
        .sortWithinPartitions(DAY, "provider", "gpu_name")
        .write.mode("append")
        .option("parquet.bloom.filter.enabled#snapshot_id", "true")
        .option("parquet.bloom.filter.expected.ndv#snapshot_id", RUNS_IN_GROUP)
        .option("parquet.block.size", ROW_GROUP)
        .partitionBy(DAY)
        .parquet(path)
    )


def read_offers(spark: SparkSession, path: str, schema: T.StructType = schemas.OFFERS) -> DataFrame:
    """Offers written by ``append_offers``; filter on ``capture_date`` to prune days."""
    wanted = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    return spark.read.schema(wanted).parquet(path)


def append_snapshots(runs: DataFrame, path: str) -> None:
    """Append rows of the run log; a run may come again with its end or more rows."""
    runs.write.mode("append").parquet(path)


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType = schemas.SNAPSHOTS) -> DataFrame:
    """The run log: of each run the row that ended last, a row without end only if there is no other."""
    rows = spark.read.schema(schema).parquet(path)
    others = [c for c in schema.names if c != "snapshot_id"]
    latest = F.max_by(F.struct(*others), F.struct(F.coalesce("finished_at", F.lit("0001-01-01").cast("timestamp")), "all_offers"))
    return rows.groupBy("snapshot_id").agg(latest.alias("r")).select("snapshot_id", *[F.col(f"r.{c}").alias(c) for c in others])


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of another store (times as ISO text) in the declared columns and types.

    Meant for a one-off import, e.g. of ``spark.read.jdbc`` split on the row id.
    """
    return rows.select(
        *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def land_payloads(payloads: DataFrame, path: str) -> None:
    """Append payloads, partitioned by day and source so that each reader scans only its own."""
    payloads.withColumn(DAY, F.to_date("captured_at")).write.mode("append").partitionBy(DAY, "source").parquet(path)


def landed_schema(schema: T.StructType = schemas.PAYLOADS) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])


def read_payloads(spark: SparkSession, path: str, schema: T.StructType = schemas.PAYLOADS) -> DataFrame:
    return spark.read.schema(landed_schema(schema)).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, one folder of part files; null fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _at(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, as Spark resolves them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _at(spark, path)
    return files.exists(target)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none where it does not exist."""
    files, target = _at(spark, path)
    return [f.getPath().getName() for f in files.listStatus(target) if f.isDirectory()] if files.exists(target) else []


def delete_path(spark: SparkSession, path: str) -> None:
    files, target = _at(spark, path)
    files.delete(target, True)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines of a known shape; an absent path is an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def read_spot_lines(spark: SparkSession, path: str, split_bytes: int = archives.SPLIT_BYTES) -> DataFrame:
    """Lines of spot-price archives with their ``file`` and order in it, ``seq``; each archive is read by a task per run of frames."""
    return archives.read_lines(spark, path, split_bytes)
