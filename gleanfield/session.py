"""Session settings, lineage cuts and the size check behind every broadcast."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Python batches hold whole page bodies, so they are kept short.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def configure(spark: SparkSession, task_bytes: str | None = None) -> SparkSession:
    """`task_bytes` is what a shuffle hands to one task: less than Spark's 64 MB where the work on small rows is long."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if task_bytes is None:
        spark.conf.unset(TASK_BYTES)
    else:
        spark.conf.set(TASK_BYTES, task_bytes)
    return spark


def local_session(cores="*", shuffle_partitions=8, **conf) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gleanfield")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder named by `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder: executors of a
    cluster do not share one.
    """
    _checkpoint_folder(df)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Files below the checkpoint folder, read again: what a loop hands from round to round.

    A checkpoint keeps Spark's estimate of its size. A join's estimate is a product, so its digits
    double with each round, until planning takes longer than the work.
    """
    spark = df.sparkSession
    folder = f"{_checkpoint_folder(df)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _checkpoint_folder(df: DataFrame) -> str:
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="gleanfield-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def small_side(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint `df` for broadcast when its rows and bytes, counted in full, prove it small.

    Each partition is reduced to one row of sums, so nothing large meets in one task. A larger
    side is hinted for a merge join, or Spark's estimate, which knows neither how well a file is
    compressed nor what `explode` makes of a row, could still have the driver broadcast it.
    The join then shuffles, and adaptive execution splits its hot keys.
    """
    if df.isStreaming:
        return df
    width = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    ).first()
    return F.broadcast(df) if seen.rows <= max_rows and seen.bytes <= max_bytes else df.hint("merge")
