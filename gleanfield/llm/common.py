"""What the operators of this subpackage share: words, stored tables, a crc32 split."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII letters and ASCII white space only; Python's bytes.lower() and bytes.split() agree with these.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`, which the driver and all executors see.

    Only a local master may do without that setting: executors of a cluster
    do not share a temporary folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="gleanfield-llm-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """`df` written as Parquet into the shared folder and read again.

    The plan is cut there, lost executors cost no recomputation before this
    point, and what the rows hold cannot change between two readings.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def short_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Python batches hold whole texts, so they are kept short."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo `divisor`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor
