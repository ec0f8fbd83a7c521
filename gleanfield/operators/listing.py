"""From listing pages to detail pages: seeds, pagination, request dedupe, context."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanfield.session import stored


def calendar_seed(
    df: DataFrame, base: str, path: str, start: Column, months: int = 24
) -> DataFrame:
    """Per input row one listing URL for each of the next `months` months."""
    first = F.trunc(start, "MM")
    grid = F.sequence(first, F.add_months(first, months - 1), F.expr("interval 1 month"))
    return df.withColumn("_month", F.explode(grid)).select(
        *df.columns,
        F.month("_month").alias("month"),
        F.year("_month").alias("year"),
        F.concat(
            F.lit(f"{base}{path}?month="), F.month("_month").cast("string"),
            F.lit("&year="), F.year("_month").cast("string"),
        ).alias("url"),
    )


def dedupe_requests(df: DataFrame, order: list[str] | None = None, key: str = "url") -> DataFrame:
    """One row per URL, the first by `order` where given.

    Copies of a URL are reduced within each input partition before the shuffle.
    """
    if not order:
        return df.dropDuplicates([key])
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(key, "_row.*").select(*df.columns)


def attach_listing_context(
    detail: DataFrame, listing: DataFrame, columns: list[str], on: str = "url",
    order: list[str] | None = None,
) -> DataFrame:
    """Fill NULLs of the detail record from the listing entry with the same URL.

    A URL listed twice counts once, as it is requested once.
    """
    context = dedupe_requests(
        listing.select(on, *columns, *[o for o in order or [] if o not in [on, *columns]]), order, on
    ).select(on, *[F.col(c).alias(f"_listing_{c}") for c in columns])
    joined = detail.join(context, on, "left")
    filled = [c for c in detail.columns if c not in columns]
    return joined.select(
        *filled,
        *[
            F.coalesce(*([F.col(c)] if c in detail.columns else []), F.col(f"_listing_{c}")).alias(c)
            for c in columns
        ],
    )


def follow_pagination(
    links: DataFrame, seeds: DataFrame, max_depth: int | None = None, per_seed: bool = True
) -> DataFrame:
    """L4: pages reached through next links: `seed`, `url`, `depth`.

    `links` holds `url`, `next_url` (NULL at the end), `seeds` holds `seed`. Each round
    doubles the jump length, so a chain of n pages takes log2(n) rounds, each cut off by one
    stored table that holds jumps and reached pages. A page met again ends the chain, and so
    does `max_depth` where given. Without `per_seed` a page counts once however many seeds
    reach it (`seed` is NULL), so that seeds of one chain do not multiply its pages.
    """
    seed = F.col("seed") if per_seed else F.lit(None).cast("string")
    at = F.lit(None).cast("long")
    jump = links.where(F.col("next_url").isNotNull()).groupBy("url").agg(
        F.min("next_url").alias("next_url")
    )
    start = seeds.select(
        seed.alias("seed"), F.col("seed").alias("url"), F.lit(0).cast("long").alias("depth")
    ).distinct()
    blank = F.lit(None).cast("string")

    def kept(jump: DataFrame, reached: DataFrame) -> tuple[DataFrame, DataFrame]:
        both = jump.select(blank.alias("seed"), "url", "next_url", at.alias("depth")).unionByName(
            reached.select("seed", "url", blank.alias("next_url"), "depth")
        )
        both = stored(both)
        return (
            both.where("depth is null").select("url", "next_url"),
            both.where("depth is not null").select("seed", "url", "depth"),
        )

    jump, reached = kept(jump, start)
    length, pages = 1, reached.count()
    while max_depth is None or length <= max_depth:
        further = reached.join(jump.hint("merge"), "url").select(
            "seed", F.col("next_url").alias("url"), (F.col("depth") + length).alias("depth")
        )
        if max_depth is not None:
            further = further.where(F.col("depth") <= max_depth)
        grown = reached.unionByName(further).groupBy("seed", "url").agg(F.min("depth").alias("depth"))
        after = jump.select(F.col("url").alias("next_url"), F.col("next_url").alias("_far"))
        longer = jump.join(after.hint("merge"), "next_url").select("url", F.col("_far").alias("next_url"))
        jump, reached = kept(longer, grown)
        now = reached.count()
        if now == pages:
            break
        pages, length = now, length * 2
    return reached
