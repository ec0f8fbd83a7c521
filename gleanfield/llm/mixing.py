"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each source has a target number of words. Document rates w, between 0 and `most`
copies, are as close to one copy each as the targets allow: of all rates that meet them
they have the least relative entropy (of w against its unused part `most` - w). They have the form
w / (most - w) = exp(lambda * size / mean size), one lambda per source, and the
lambdas maximise a concave dual whose gradient is words wanted minus words
taken. Newton steps find them over the histogram of (source, size).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanfield.llm.common import WORD, stored

# Rows per bin in which rates are rounded: a bin's rows are one array in one task.
BIN_ROWS = 128


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """`df` with `number`, the place of each row in `order` from 0, without one task for all rows."""
    part = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    part = stored(part)
    # one row per range of the partitioning
    starts = part.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return part.join(starts, "__part").withColumn("number", F.col("__start") + within).drop("__part", "__start")


def targets(sources: DataFrame, share: float, weights: tuple[float, ...], most: float) -> DataFrame:
    """`sources` (source, source_size) with `target`.

    `weights` go round the sources by code point, null last. All targets make
    up `share` times all words; none is above `most` times its source, and what is over goes to
    the others by weight: a common level per weight, raised until it no longer changes.
    """
    ranked = numbered(sources, F.col("source").asc_nulls_last())
    by_turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("weight", by_turn).withColumn("bound", most * F.col("source_size")))
    level, total = 0.0, None
    while True:
        full = F.col("bound") < F.lit(level) * F.col("weight")
        got = ranked.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("bound"))).alias("full"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        total = share * (got["all"] or 0)
        raised = (total - (got["full"] or 0.0)) / got["open"] if got["open"] else level
        if raised <= level * (1 + 1e-15):
            break
        level = raised
    return ranked.withColumn("target", F.least("bound", F.lit(level) * F.col("weight"))).drop("weight", "bound", "number")


def rate(tilt: Column, size: Column, mean: Column, most: float) -> Column:
    return most / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), tilt * size / mean))))


def tilts(histogram: DataFrame, wanted: DataFrame, most: float, rounds: int = 60, near: float = 1e-7) -> DataFrame:
    """`wanted` (source, source_size, target, mean) with `tilt`, the lambda of each source.

    `histogram` has source, size and n. Newton steps are bounded, and one that leaves the
    interval known to hold the solution is replaced by its middle; sources whose target is
    all (or nothing) have an infinite tilt, written as 1e300 (or -1e300). The
    first tilt is the one that fits if all sizes were the mean.
    """
    ratio = F.col("target") / F.col("source_size")
    state = wanted.withColumns(
        {
            "tilt": F.when(F.col("target") >= most * F.col("source_size"), 1e300)
            .when(F.col("target") <= 0, -1e300).otherwise(F.log(ratio / (most - ratio))),
            "low": F.lit(-1e9), "high": F.lit(1e9), "off": F.lit(1.0),
        }
    )
    state = stored(state)
    for _ in range(rounds):
        open_ = state.where((F.abs("tilt") < 1e299) & (F.col("off") > near))
        w = rate(F.col("tilt"), F.col("size"), F.col("mean"), most)
        words_taken = F.col("n") * F.col("size") * w
        slope = words_taken * F.col("size") / F.col("mean") * (1 - w / most)
        steps = (
            histogram.join(open_.select(F.col("source").alias("__source"), "tilt", "mean"), F.col("source").eqNullSafe(F.col("__source")))
            .groupBy("__source").agg(F.sum(words_taken).alias("__taken"), F.sum(slope).alias("__slope"))
        )
        over = F.col("__taken") - F.col("target")
        low = F.when(over < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        most_step = 4 + 4 * F.abs("tilt")
        step = F.when(F.col("__slope") > 0, -over / F.col("__slope")).otherwise(-F.signum(over) * most_step)
        tried = F.col("tilt") + F.greatest(-most_step, F.least(most_step, step))
        next_tilt = F.when((tried > low) & (tried < high), tried).otherwise((low + high) / 2)
        joined = state.join(steps, F.col("source").eqNullSafe(F.col("__source")), "left")
        moved = F.col("__taken").isNotNull()
        state = stored(
            joined.select(
                "source", "source_size", "target", "mean",
                F.when(moved, next_tilt).otherwise(F.col("tilt")).alias("tilt"),
                F.when(moved, low).otherwise(F.col("low")).alias("low"),
                F.when(moved, high).otherwise(F.col("high")).alias("high"),
                F.when(moved, F.abs(over) / F.col("target")).otherwise(F.lit(0.0)).alias("off"),
            )
        )
        off = state.agg(F.max("off").alias("off")).first()["off"] or 0.0
        if off <= near:
            break
    # sums of doubles depend on the order of rows in their last digits, which must not reach a rounding
    return state.select("source", "source_size", "target", "mean", F.round("tilt", 9).alias("tilt"))


def allotted(
    sized: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3.0, 1.0, 2.0), most: int = 2
) -> DataFrame:
    """How often the rows of `sized` (doc_id, source, size, mark) are taken, one row for all that are equal.

    Adds source_size, target, rate, n (rows that are equal) and copies, of all `n` together. Equal rows are
    counted before they meet, so a group of any size is one entry of a bin.
    """
    sized = stored(sized.groupBy("source", "doc_id", "size", "mark").agg(F.count(F.lit(1)).alias("n")))
    histogram = stored(sized.groupBy("source", "size").agg(F.sum("n").alias("n")))
    sources = histogram.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows")
    )
    sources = stored(targets(sources, share, weights, most))
    wanted = sources.select("source", "source_size", "target", F.greatest(F.col("source_size") / F.col("rows"), F.lit(1e-9)).alias("mean"))
    solved = tilts(histogram, wanted, most).join(
        sources.select(F.col("source").alias("__source"), "rows"), F.col("source").eqNullSafe(F.col("__source"))
    ).drop("source")
    rated = sized.join(solved, F.col("source").eqNullSafe(F.col("__source"))).select(
        "doc_id", "source", "size", "mark", "n", "source_size", "target",
        rate(F.col("tilt"), F.col("size"), F.col("mean"), most).alias("rate"),
        F.pmod(F.xxhash64("doc_id", "size", "mark"), F.ceil(F.col("rows") / BIN_ROWS)).alias("bin"),
    )
    binned = rated.groupBy("source", "bin").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sort_array(F.collect_list(F.struct("size", "doc_id", "rate", "mark", "n")), asc=False).alias("rows"),
    )

    def rounded(state, row):
        need = state["left"] + row["rate"] * row["size"] * row["n"]
        bound = F.least(row["n"].cast("double") * most, F.greatest(F.lit(0.0), F.round(need / row["size"])))
        copies = F.when(row["size"] > 0, bound).otherwise(0.0)
        taken = F.struct(*[row[c].alias(c) for c in ("doc_id", "size", "rate", "mark", "n")], copies.cast("long").alias("copies"))
        return F.struct((need - copies * row["size"]).alias("left"), F.array_append(state["rows"], taken).alias("rows"))

    none = F.expr("cast(array() as array<struct<doc_id: bigint, size: bigint, rate: double, mark: bigint, n: bigint, copies: bigint>>)")
    out = F.aggregate("rows", F.struct(F.lit(0.0).alias("left"), none.alias("rows")), rounded, lambda s: s["rows"])
    return binned.select("source", "source_size", "target", F.explode(out).alias("row")).select(
        "source", "source_size", "target", "row.*"
    )


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, source and size of each row of `docs`, the row itself, and as mark a hash of it."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), words(F.col("text")).alias("size"), F.struct(*columns).alias("row"),
        F.xxhash64(*columns).alias("mark"),
    )


def counted(df: DataFrame, n: Column, name: str) -> DataFrame:
    """Each row of `df` `n` times, numbered from 0; no array is longer than a thousand of them or a thousandth of `n`."""
    blocks = df.withColumn("__block", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / 1000))))
    low = F.col("__block") * 1000
    return blocks.withColumn(name, F.explode(F.sequence(low, F.least(low + 999, n - 1)))).drop("__block")


def mix(
    docs: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3.0, 1.0, 2.0), most: int = 2
) -> DataFrame:
    """How often each row of `docs` (doc_id, text, source) is taken.

    Returns doc_id, source, size, source_size, target, rate, copies (0 to `most`) and
    taken (copies times size). Rates are rounded within bins of about
    `BIN_ROWS` documents of one source, longest first, what a rounding left over going on
    to the next: a bin's words are off by about half its shortest document.

    A null text counts as empty and is not taken; null sources are a source of
    their own, the last; rows that are equal in all columns are rounded together, and their copies differ by
    one at most; an empty table gives no rows; further columns only tell rows apart.
    """
    each = counted(allotted(keyed(docs).drop("row"), share, weights, most), F.col("n"), "place")
    copies = F.floor(F.col("copies") / F.col("n")) + F.when(F.col("place") < F.col("copies") % F.col("n"), 1).otherwise(0)
    return each.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def repeat_rows(docs: DataFrame, **how) -> DataFrame:
    """`docs` as mixed: every row as often as it is taken, all columns as they were.

    Rows that are equal in all columns are reduced to one before they meet, and that one is repeated for all.
    """
    key = F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("mark").cast("string"), F.col("source"))
    rows = keyed(docs).select("row", key.alias("__key")).groupBy("__key").agg(F.first("row").alias("row"))
    taken = allotted(keyed(docs).drop("row"), **how).where("copies > 0").select(key.alias("__key"), "copies")
    taken = counted(rows.join(taken, "__key"), F.col("copies"), "place")
    return taken.select(*[F.col(f"row.`{c}`") for c in docs.columns])
