"""Nearest neighbours by inner product: a vantage-point tree per shard.

Vectors get one more component so that all have the same length, queries a zero and that same length; nearest
by distance is then largest by inner product, and distances obey the triangle inequality. A tree node keeps a
vantage point and the ranges of distances to it of its two halves, so a query's distance to the vantage point
bounds its distance to all vectors of a half from below. A leaf is left out when `factor` times its bound
exceeds the distance of the query's worst neighbour so far: factor 1 is exact, larger ones search less.

The upper levels are one tree over a bounded sample; its leaves are the shards. Every query searches the shard
it falls into, then the other shards that its bounds leave in.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanfield.llm.common import stored

LEAF_ROWS = 64
# Distances come from squares, so near zero they are off by up to this share of the longest vector.
SLACK = 2e-6
SHARD_ROWS = 16_000
SAMPLE_ROWS = 20_000


@dataclass
class Node:
    vantage: np.ndarray | None = None
    ranges: tuple = ()  # least and greatest distance of the near and the far half
    near: "Node | None" = None
    far: "Node | None" = None
    middle: float = 0.0
    number: int = -1
    leaf: int = -1


@dataclass
class Tree:
    root: Node
    leaves: list[np.ndarray]  # rows of each leaf
    inner: list[Node]

    @classmethod
    def build(cls, points: np.ndarray, leaf_rows: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        leaves: list[np.ndarray] = []
        inner: list[Node] = []

        def grow(rows):
            node = Node()
            if len(rows) > leaf_rows:
                node.number = len(inner)
                inner.append(node)
                # of a few candidates the one whose distances differ most
                some = points[rng.choice(rows, min(200, len(rows)), replace=False)]
                tried = points[rng.choice(rows, min(8, len(rows)), replace=False)]
                spread = [distances(v[None], some)[0].std() for v in tried]
                node.vantage = tried[int(np.argmax(spread))]
                far = distances(node.vantage[None], points[rows])[0]
                node.middle = float(np.median(far))
                inside = far <= node.middle
                if inside.all() or not inside.any():  # many at one distance: halves by position
                    inside = np.arange(len(rows)) < len(rows) // 2
                node.ranges = tuple((float(far[x].min()), float(far[x].max())) for x in (inside, ~inside))
                node.near, node.far = grow(rows[inside]), grow(rows[~inside])
            else:
                node.leaf = len(leaves)
                leaves.append(rows)
            return node

        return cls(grow(np.arange(len(points))), leaves, inner)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Lower bounds of each query's distance to each leaf's vectors."""
        out = np.zeros((len(queries), len(self.leaves)))

        def walk(node, bound):
            if node.vantage is None:
                out[:, node.leaf] = bound
                return
            d = distances(queries, node.vantage[None])[:, 0]
            for child, (low, high) in zip((node.near, node.far), node.ranges):
                walk(child, np.maximum(bound, np.maximum(low - d, d - high)))

        walk(self.root, np.zeros(len(queries)))
        return out

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf each point falls into."""
        out = np.zeros(len(points), np.int64)

        def walk(node, rows):
            if node.vantage is None:
                out[rows] = node.leaf
                return
            inside = distances(points[rows], node.vantage[None])[:, 0] <= node.middle
            walk(node.near, rows[inside])
            walk(node.far, rows[~inside])

        walk(self.root, np.arange(len(points)))
        return out

    def spans(self, points: np.ndarray):
        """(node, half, least, greatest distance) of the halves that hold any of `points`."""
        out = []

        def walk(node, rows):
            if node.vantage is None or not len(rows):
                return
            d = distances(points[rows], node.vantage[None])[:, 0]
            inside = d <= node.middle
            for half, x, child in ((0, inside, node.near), (1, ~inside, node.far)):
                if x.any():
                    out.append((node.number, half, float(d[x].min()), float(d[x].max())))
                    walk(child, rows[x])

        walk(self.root, np.arange(len(points)))
        return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0.0))
    return np.concatenate([vectors, rest[:, None]], 1)


def as_queries(vectors: np.ndarray, longest: float) -> np.ndarray:
    scaled = vectors * (longest / np.sqrt((vectors**2).sum(1)))[:, None]
    return np.concatenate([scaled, np.zeros((len(vectors), 1))], 1)


def reach(score: np.ndarray, length: np.ndarray, longest: float) -> np.ndarray:
    """The distance at which a vector scores that much for a query of that length, rounding errors added."""
    with np.errstate(invalid="ignore"):
        square = 2 * longest**2 - 2 * longest * score / length
    return np.where(np.isneginf(score), np.inf, np.sqrt(np.maximum(square, 0.0))) + SLACK * longest


def search(
    tree: Tree, own: np.ndarray, first: np.ndarray, ask: np.ndarray, worst: np.ndarray, k: int, factor: float, longest: float
):
    """For each query up to k rows of `own`, which `tree` holds lengthened, that score at least `worst`, as (rows, scores), -1 where there are fewer.

    They are the best by score, the sum of products in double precision, then by the smaller of `first`. A leaf is
    left out only if all in it score less.
    """
    n = len(ask)
    rows, ids = np.full((n, k), -1, np.int64), np.full((n, k), np.iinfo(np.int64).max)
    best = np.full((n, k), -np.inf)
    length = np.sqrt((ask * ask).sum(1))
    close = 1e-12 * longest * length
    bound = tree.bounds(as_queries(ask, longest))
    order = np.argsort(bound, 1)
    open_ = np.arange(n)
    for turn in range(order.shape[1]):
        limit = np.maximum(best[open_, -1], worst[open_])
        open_ = open_[bound[open_, order[open_, turn]] * factor <= reach(limit, length[open_], longest)]
        if not len(open_):
            break
        leaf = order[open_, turn]
        by_leaf = np.argsort(leaf, kind="stable")
        for group in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
            asked, members = open_[group], tree.leaves[leaf[group[0]]]
            limit = np.maximum(best[asked, -1], worst[asked])
            i, j = np.nonzero(ask[asked] @ own[members].T >= (limit - close[asked])[:, None])
            found = np.full((len(asked), len(members)), -np.inf)
            exact = (ask[asked[i]] * own[members[j]]).sum(1)
            found[i, j] = np.where(exact >= worst[asked[i]], exact, -np.inf)
            scores = np.concatenate([best[asked], found], 1)
            names = np.concatenate([rows[asked], np.where(np.isneginf(found), -1, members)], 1)
            seconds = np.concatenate([ids[asked], np.broadcast_to(first[members], found.shape)], 1)
            keep = np.lexsort((seconds, -scores), axis=1)[:, :k]
            best[asked], rows[asked], ids[asked] = (np.take_along_axis(x, keep, 1) for x in (scores, names, seconds))
    return rows, best


def clean(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding as doubles) of rows with an id and a usable vector of the most common length."""
    inf = float("inf")
    usable = F.col("vec_id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(usable)
    rows = stored(rows.distinct())
    lengths = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.where(F.size("v") == (lengths["size"] if lengths else 0))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def spanned(placed: DataFrame, top: Tree, longest: float) -> Tree:
    """`top` with the ranges of all placed vectors instead of the sample's; two rows per node reach the driver."""

    def compute(batches):
        for batch in batches:
            own = matrix(pa.chunked_array([batch.column(0)]))
            rows = top.spans(lengthened(own, longest)) if len(own) else []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["node", "half", "low", "high"])

    found = placed.select("v").mapInArrow(compute, "node long, half long, low double, high double")
    ranges = [[(np.inf, -np.inf)] * 2 for _ in top.inner]
    for r in found.groupBy("node", "half").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        ranges[r["node"]][r["half"]] = r["low"], r["high"]
    for node in top.inner:
        node.ranges = tuple(ranges[node.number])
    return top


def nearest(
    vectors: DataFrame, is_query, k: int = 20, factor: float = 2.0, shard_rows: int | None = None
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for each query row.

    `vectors` has vec_id and embedding, `is_query` is a condition on vec_id. Nearest is the largest inner
    product in double precision, ties go to the smaller vec_id, a row with the query's own id is
    left out. Equal vectors are searched, and found, as one: of a vector's copies the k + 1 smallest ids
    are enough, so a vector held by very many rows costs no more than any other. A shard has about `shard_rows`
    vectors; one that more fall into than a sample foretold is searched in parts of that size.

    Rows whose vector is null, empty, zero, holds null or non-finite components, or is of another length
    than most, and rows without an id, take no part. Repeated rows count once. An empty
    table gives no rows; further columns are not looked at.
    """
    spark, shard_rows = vectors.sparkSession, shard_rows or SHARD_ROWS
    rows = clean(vectors)
    few = rows.withColumn("turn", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("turn") <= k + 1)
    classes = stored(
        few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("class"), "ids", "v")
    )
    # several ids may share their smallest one only if an id has several vectors
    classes = stored(classes.withColumns({"first": F.col("class"), "class": F.xxhash64("class", "v")}))
    asking = stored(rows.where(is_query).join(classes.select("class", "v"), "v").select("vec_id", "class"))
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("longest")).first()
    result = "query long, class long, score double"
    if not size["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = size["longest"]
    shards = max(1, -(-size["n"] // shard_rows))
    sample = classes.select("v").orderBy(F.xxhash64("v")).limit(SAMPLE_ROWS if shards > 1 else 2).toArrow()
    points = lengthened(matrix(sample.column(0)), longest)
    top = Tree.build(points, max(2, len(points) // shards))
    shared = spark.sparkContext.broadcast(top)

    def assign(batches):
        for batch in batches:
            own = matrix(pa.chunked_array([batch.column("v")]))
            home = shared.value.home(lengthened(own, longest)) if len(own) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int64())], names=["class", "first", "v", "shard"])

    placed = classes.select("class", "first", "v").mapInArrow(assign, "class long, first long, v array<double>, shard long")
    placed = stored(placed)
    # a shard that more vectors fall into than the sample foretold is searched in parts
    crowded = stored(placed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("parts")))
    placed = placed.join(F.broadcast(crowded), "shard").withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")))
    queries = asking.select("class").distinct().join(placed.select("class", "v"), "class").select(F.col("class").alias("query"), "v")

    def first_shard(batches):
        for batch in batches:
            own = matrix(pa.chunked_array([batch.column("v")]))
            home = shared.value.home(as_queries(own, longest)) if len(own) else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int64()), pa.array([-np.inf] * len(own), pa.float64())], names=["query", "v", "shard", "worst"])

    asked = "query long, v array<double>, shard long, worst double"

    def in_shard(held: pa.Table, wanted: pa.Table) -> pa.Table:
        names = ["query", "class", "score"]
        if not held.num_rows or not wanted.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names=names)
        own, ask = matrix(held.column("v")), matrix(wanted.column("v"))
        classes, first = held.column("class").to_numpy(), held.column("first").to_numpy()
        ids, worst = wanted.column("query").to_numpy(), wanted.column("worst").to_numpy()
        tree = Tree.build(lengthened(own, longest), LEAF_ROWS)
        found = []
        for a in range(0, len(ask), 2000):
            at, score = search(tree, own, first, ask[a : a + 2000], worst[a : a + 2000], k + 1, factor, longest)
            i, j = np.nonzero(at >= 0)
            found.append((ids[a + i], classes[at[i, j]], score[i, j]))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*found)], names=names)

    def searched(wanted: DataFrame) -> DataFrame:
        # a shard asked by very many queries is searched in blocks of them
        blocks = wanted.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / 20_000).alias("blocks"))
        blocks = blocks.join(crowded, "shard")
        several = placed.join(blocks.drop("parts"), "shard").select(
            "shard", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "class", "first", "v"
        )
        dealt = wanted.join(blocks, "shard").select(
            "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("query"), F.col("blocks")).alias("block"), "query", "v", "worst",
        )
        key = ["shard", "part", "block"]
        return several.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(in_shard, result)

    near = stored(searched(queries.mapInArrow(first_shard, asked)))
    found = near
    if shards > 1:
        # the score of the (k + 1)-th best so far
        ranked = near.withColumn("turn", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"))))
        worst = ranked.groupBy("query").agg(F.max(F.when(F.col("turn") == k + 1, F.col("score"))).alias("worst"))
        span = spark.sparkContext.broadcast(spanned(placed, top, longest))

        def other_shards(batches):
            for batch in batches:
                own = matrix(pa.chunked_array([batch.column("v")]))
                if not len(own):
                    continue
                ask = as_queries(own, longest)
                home, worst = shared.value.home(ask), batch.column("worst").to_numpy(zero_copy_only=False).copy()
                worst[np.isnan(worst)] = -np.inf
                bound = span.value.bounds(ask)
                bound[np.arange(len(own)), home] = np.inf
                i, j = np.nonzero(bound * factor <= reach(worst, np.sqrt((own * own).sum(1)), longest)[:, None])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query").take(pa.array(i)), batch.column("v").take(pa.array(i)), pa.array(j.astype(np.int64)), pa.array(worst[i])],
                    names=["query", "v", "shard", "worst"],
                )

        more = queries.join(worst, "query", "left").select("query", "v", "worst").mapInArrow(other_shards, asked)
        found = stored(near.unionByName(searched(more)))
    # k + 1 classes, and all that tie with the last of them
    best = found.withColumn("turn", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(F.col("turn") <= k + 1)
    rows_of = best.join(classes.select("class", "ids"), "class").select("query", "score", F.explode("ids").alias("vec_id"))
    most = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    few = rows_of.withColumn("turn", F.row_number().over(most)).where(F.col("turn") <= k + 1).drop("turn")
    out = asking.select(F.col("vec_id").alias("query_id"), F.col("class").alias("query")).join(few, "query").where("query_id <> vec_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
