"""Registration of queries and the frames they share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanfield.operators.gazetteer import Gazetteer
from gleanfield.session import configure
from gleanfield.sources.io import spread

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL of its expected rows."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(configure(spark, task_bytes="16m"), folder))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def bodies(self, name: str) -> DataFrame:
        """A table for heavy work per row, on all cores."""
        return spread(getattr(self, name))

    def bookings(self) -> DataFrame:
        """Orders as raw material for events: who, where, from when to when."""
        joined = (
            self.bodies("orders").join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        )
        return joined.selectExpr(*BOOKING)

    def gazetteer(self) -> Gazetteer:
        """Nations as countries, nation and region as subdivisions."""
        nation = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
        countries = nation.selectExpr(
            "n_nationkey ord", "n_name name", "chr(65 + n_nationkey) || 'Q' alpha_2",
            "chr(65 + n_nationkey) || 'QX' alpha_3",
        )
        subdivisions = nation.selectExpr(
            "n_nationkey ord", "chr(65 + n_nationkey) || 'Q-' || left(r_name, 2) code",
            "r_name || ' of ' || n_name name", "chr(65 + n_nationkey) || 'Q' alpha_2",
        )
        return Gazetteer(countries, subdivisions)

    def out_folder(self) -> str:
        """A new folder beside the checkpoints, which all executors see."""
        sc = self.spark.sparkContext
        base = sc.getConf().get("spark.checkpoint.dir")
        if base is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            base = tempfile.mkdtemp(prefix="gleanfield-out-")
        return f"{base}/out-{uuid.uuid4().hex}"


BOOKING = [
    "o_orderkey k", "c_name who", "n_name country", "n_nationkey cn", "o_orderstatus status",
    "cast(o_orderdate as date) s", "date_add(cast(o_orderdate as date), cast(o_orderkey % 4 as int)) e",
    "o_totalprice price", "c_mktsegment seg", "o_orderpriority prio",
    "element_at(array('Forum', 'SUMMIT', 'expo and congress', 'meeting', 'Workshop'), "
    "cast(o_orderkey % 5 + 1 as int)) kind",
]

# The same rows for the expected results.
BOOKINGS = """
bookings as (
  select o_orderkey k, c_name who, n_name country, n_nationkey cn, o_orderstatus status,
    cast(o_orderdate as date) s, cast(cast(o_orderdate as date) + cast(o_orderkey % 4 as int) as date) e,
    o_totalprice price, c_mktsegment seg, o_orderpriority prio,
    ['Forum', 'SUMMIT', 'expo and congress', 'meeting', 'Workshop'][cast(o_orderkey % 5 + 1 as int)] kind
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)
"""
