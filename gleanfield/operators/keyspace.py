"""Refinement of search terms whose result list is capped, one step or until none is."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanfield.functions.urls import pack_url, unpack_url
from gleanfield.session import cut_lineage

# Fixed value: characters a term may be extended with.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"


def string_combinations(
    df: DataFrame,
    seed: str,
    min_length: int | Column = 1,
    start: str | None = None,
    end: str | None = None,
    pattern: str | None = None,
    alphabet: str | None = None,
    variants: dict[str, list[str]] | None = None,
    index: int | None = None,
    max_levels: int | None = None,
    out: str = "term",
) -> DataFrame:
    """K1: extensions of `seed` by at least one character, up to `min_length`.

    One `explode` of the alphabet per level, pruned by the bounds as soon as the prefix
    decides them; a term that is long enough stays as it is, so the number of terms depends on
    the characters missing, not on `min_length`. A term's prefix must lie between `start` and `end` (both inclusive) and
    every longer prefix must match `pattern`. A character with `variants` also stands for
    each of those, whole. With `index` the characters from there on are replaced, not
    appended. `min_length` may be a column; `max_levels` then bounds the growth.
    """
    steps = [s for c in alphabet or ALPHABET for s in [c, *(variants or {}).get(c, [])]]
    if isinstance(min_length, int):
        length = F.lit(min_length)
        max_levels = min(max_levels or min_length, min_length)
    elif max_levels is None:
        raise ValueError("a min_length column needs max_levels")
    else:
        length = min_length
    place = F.length(seed) if index is None else F.lit(index)
    level = df.select(
        "*", length.alias("_min"), F.col(seed).alias("_term"), place.cast("int").alias("_at")
    ).where(F.col(seed).isNotNull())
    for n in range(max(max_levels, 1)):
        grow = F.lit(True) if n == 0 else F.length("_term") < F.col("_min")
        stay = F.array(F.lit(None).cast("string"))
        level = level.withColumn(
            "_step", F.explode(F.when(grow, F.array(*map(F.lit, steps))).otherwise(stay))
        )
        at = F.col("_at")
        term = F.concat(
            F.expr("substring(_term, 1, _at)"), F.col("_step"), F.expr("substring(_term, _at + 2)")
        )
        level = level.withColumn("_term", F.coalesce(term, "_term")).withColumn(
            "_at", F.coalesce(at + F.length("_step"), at)
        ).drop("_step")
        kept = _within_bounds(F.expr("substring(_term, 1, _at)"), start, end)
        if pattern is not None:
            kept.append(F.col("_term").rlike(pattern))
        if kept:
            level = level.where(reduce(lambda a, b: a & b, kept))
    if not isinstance(min_length, int):
        level = level.withColumn(
            "_term",
            F.when(F.length("_term") < F.col("_min"), F.raise_error(F.lit("max_levels too low")))
            .otherwise(F.col("_term")),
        )
    whole = _within_bounds(F.col("_term"), start, end)
    level = reduce(lambda d, c: d.where(c), whole, level)
    return level.select(*df.columns, F.col("_term").alias(out))


def _within_bounds(prefix: Column, start, end) -> list[Column]:
    """What the prefix decides: both sides cut to the shorter length."""
    kept = []
    for bound, ok in ((start, lambda p, b: p >= b), (end, lambda p, b: p <= b)):
        if bound:
            kept.append(
                ok(F.left(prefix, F.lit(len(bound))), F.left(F.lit(bound), F.length(prefix)))
            )
    return kept


def refine_capped_queries(
    df: DataFrame, url_col: str, capped: Column, query_param: str, min_length: int = 1,
    max_levels: int | None = None, **combinations,
) -> DataFrame:
    """K2: for each URL with a capped result, URLs asking for each longer term.

    Adds `term` and `new_url`. A URL without the parameter gives none, and so does the
    term it already has.
    """
    parts = unpack_url(F.col(url_col))
    asked = df.where(capped).withColumn("_parts", parts).withColumn(
        "_seed", F.get(F.filter("_parts.query", lambda p: p["k"] == query_param), F.lit(0))["v"]
    )
    longer = string_combinations(
        asked, "_seed",
        min_length=F.greatest(F.lit(min_length), F.length("_seed") + 1),
        max_levels=max_levels or max(min_length, 1),
        **combinations,
    ).where(F.col("term") != F.col("_seed"))
    query = F.transform(
        "_parts.query",
        lambda p: F.struct(
            p["k"].alias("k"),
            F.when(p["k"] == query_param, F.col("term")).otherwise(p["v"]).alias("v"),
        ),
    )
    return longer.select(
        *df.columns, "term", pack_url(F.col("_parts").withField("query", query)).alias("new_url")
    )


def refine_to_end(
    seeds: DataFrame, captured: DataFrame, url_col: str, capped: Column, query_param: str,
    max_length: int | None = None, **combinations,
) -> DataFrame:
    """K2 to the end: capped results are refined, the new URLs looked up, and those still capped refined again.

    `seeds` holds the first URLs, `captured` the results at hand, with `capped` telling on each of its rows
    whether its list is cut off; a URL captured more than once is capped if any capture is. Gives `url`, `term`,
    `parent` (the URL it was made from, the least of several), `depth` and `outcome`:

    - `complete`: captured and not capped
    - `refined`: capped, and asked again with longer terms
    - `stuck`: capped, and no longer term may be asked: it has no such parameter, is `max_length` long, or
      the bounds of the combinations leave none
    - `missing`: not among the captured results, so what it would give is not known

    A URL is asked once however often it comes up again, so terms that lead back to each other end. Only captured
    URLs are refined, so the loop ends at the latest when all of them have been asked. Each
    level is one join with the results and one with what was asked before, cut off by a checkpoint.
    """
    results = cut_lineage(
        captured.groupBy(F.col(url_col).alias("url"))
        .agg(F.max(F.coalesce(capped, F.lit(False))).alias("_capped")).where("url is not null")
    )

    def longer(level: DataFrame) -> DataFrame:
        found = refine_capped_queries(level, "url", F.col("_capped"), query_param, **combinations)
        if max_length is not None:
            found = found.where(F.length("term") <= max_length)
        return found.where(F.col("new_url") != F.col("url"))

    asked = seeds.select(
        F.col(url_col).alias("url"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("depth")
    ).where("url is not null").distinct()
    levels: list[DataFrame] = []
    while True:
        level = cut_lineage(asked.join(results, "url", "left"))
        if levels and level.isEmpty():
            break
        levels.append(level)
        seen = reduce(DataFrame.unionByName, levels)
        new = longer(level).groupBy("new_url").agg(F.min("url").alias("parent"))
        asked = new.select(
            F.col("new_url").alias("url"), "parent", F.lit(len(levels)).alias("depth")
        ).join(seen, "url", "left_anti")
    went_on = longer(seen).select("url", F.lit(True).alias("_on")).distinct()
    outcome = (
        F.when(F.col("_capped").isNull(), "missing").when(~F.col("_capped"), "complete")
        .when(F.col("_on"), "refined").otherwise("stuck")
    )
    term = F.get(F.filter(unpack_url(F.col("url")).query, lambda p: p["k"] == query_param), F.lit(0))["v"]
    return seen.join(went_on, "url", "left").select(
        "url", term.alias("term"), "parent", "depth", outcome.alias("outcome")
    )
