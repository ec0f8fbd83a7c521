"""Merkle manifest of a table: a digest per row, one root, and a proof for every row.

Rows of a group are leaves in the order of their ids. Their rank, written in base
`FAN`, names the way from the group's root to the leaf. The rank is cut into blocks of
`FAN ** DEPTH` leaves; within a block the digits are grouped away one after the other, the
lowest first, and each level nests its children's structs into their parent's. The roots
of the blocks are the leaves of the next tier, until a group has one block. The other way
round, tier by tier, `transform` and `explode` unfold the nested children, each with its
neighbours' digests, so proofs need no joins and a block is the most that a task holds at once.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanfield.llm.common import ascii_lower, remainder, stored
from gleanfield.session import small_side

FAN, DEPTH = 8, 3
STEP = "struct<left: string, right: string>"
ABOVE = f"struct<path: array<{STEP}>, subroot: string, root: string>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def row_digest(*values: Column) -> Column:
    """SHA-256 of the values: `-` for null, else the UTF-8 byte count, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return digest(
        F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])
    )


def document_digest(text: Column) -> Column:
    """The leaf of a row of `documents` that holds `text`."""
    return row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def ranked(leaves: DataFrame) -> DataFrame:
    """`leaves` (tree, id, digest, load) as tree, n, rank, digest, load; n leaves in each tree.

    Leaves are dealt by ranges of (tree, id, digest), so a tree of any size spreads; what stands
    before a range is told by a table of one row per range and tree.
    """
    salted = leaves.withColumn("salt", F.monotonically_increasing_id())  # equal leaves spread too
    order = ["tree", "id", "digest", "salt"]
    placed = stored(
        salted.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("tree", "digest", "load", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    )
    counts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        F.col("tree").alias("base_tree"), F.col("part").alias("base_part"), F.sum("here").over(whole).alias("n"),
        (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    match = F.col("tree").eqNullSafe(F.col("base_tree")) & (F.col("part") == F.col("base_part"))
    return placed.join(small_side(stored(base)), match).select(
        "tree", "n", (F.col("at") + F.col("shift")).alias("rank"), "digest", "load"
    )


def rollup(nodes: DataFrame) -> DataFrame:
    """`nodes` (tree, levels, rank, digest, load) as one nested struct per (tree, block).

    `levels` counts the levels from a node up to its tree's root; a level beyond it holds one
    node, which goes up as it is.
    """
    digits = [F.floor(F.col("rank") / FAN**k).cast("long") % FAN for k in range(DEPTH)]
    key, names = ["tree", "levels", "block"], [f"digit{k}" for k in range(DEPTH)]
    rows = nodes.select(
        "tree", "levels", F.floor(F.col("rank") / FAN**DEPTH).cast("long").alias("block"),
        *[d.alias(n) for d, n in zip(digits, names)], F.struct("digest", "load").alias("node"),
    ).repartition("tree", "block")
    for k, digit in enumerate(names):
        child = F.struct(F.col(digit).alias("digit"), "node.*")
        rows = rows.groupBy(*key, *names[k + 1 :]).agg(F.sort_array(F.collect_list(child)).alias("children"))
        joined = F.array_join(F.transform("children", lambda c: c["digest"]), "")
        up = F.when(F.col("levels") > k, digest(joined)).otherwise(F.col("children")[0]["digest"])
        rows = rows.select(*key, *names[k + 1 :], F.struct(up.alias("digest"), "children").alias("node"))
    return rows


def beside(level: int):
    """A child with its path: the digests of the children left and right of it, before what its parent has."""
    digests, path = F.transform("node.children", lambda c: c["digest"]), F.col("above.path")

    def child(c: Column, i: Column) -> Column:
        left = F.array_join(F.slice(digests, F.lit(1), i), "")
        right = F.array_join(F.slice(digests, i + 2, F.lit(FAN)), "")
        longer = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), path)
        return F.struct(c.alias("node"), F.when(F.col("levels") > level, longer).otherwise(path).alias("path"))

    return child


def unfold(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """tree, rank, digest, load and what is `above` of every node of `blocks`.

    `above` has (tree, block, above) with the path from each block's root. Both meet in one grouping.
    """
    node_type = blocks.schema["node"].dataType
    met = blocks.select("tree", "block", "levels", "node", F.lit(None).cast(ABOVE).alias("above")).unionByName(
        above.select("tree", "block", F.lit(None).cast("int").alias("levels"), F.lit(None).cast(node_type).alias("node"), "above")
    )
    rows = met.groupBy("tree", "block").agg(*[F.first(c, True).alias(c) for c in ("levels", "node", "above")])
    rows = rows.withColumnRenamed("block", "rank")
    for k in reversed(range(DEPTH)):
        rows = rows.select(
            "tree", "rank", "levels", "above", F.explode(F.transform("node.children", beside(k))).alias("child")
        ).select(
            "tree", (F.col("rank") * FAN + F.col("child.node.digit")).alias("rank"), "levels", "child.node",
            F.struct("child.path", "above.subroot", "above.root").alias("above"),
        )
    return rows.select("tree", "rank", "node.digest", "node.load", "above")


def grown(leaves: DataFrame, roots) -> DataFrame:
    """Every leaf of `leaves` (tree, id, digest, load) with its path.

    `roots` takes (tree, subroot) of all trees and tells (tree, above) of each.
    """
    n = F.col("n")
    octal = F.length(F.conv((n - 1).cast("string"), 10, FAN))
    nodes = ranked(leaves).select("tree", F.when(n > 1, octal).otherwise(0).alias("levels"), "rank", "digest", "load")
    tiers = []
    while True:
        tiers.append(stored(rollup(nodes)))
        nodes = tiers[-1].select(
            "tree", (F.col("levels") - DEPTH).alias("levels"), F.col("block").alias("rank"), "node.digest",
            F.lit(0).alias("load"),
        )
        if not (nodes.agg(F.max("levels")).first()[0] or 0) > 0:
            break
    above = roots(nodes.select("tree", F.col("digest").alias("subroot")))
    above = above.select("tree", F.lit(0).cast("long").alias("block"), "above")
    for tier in reversed(tiers):
        found = unfold(tier, above)
        above = found.select("tree", F.col("rank").alias("block"), "above")
    return found


def manifest(leaves: DataFrame) -> DataFrame:
    """tree, rank, digest, load, subroot, root and path of every row of `leaves` (tree, id, digest, load).

    Leaves of a tree ascend by id (nulls first; equal ids by digest). While a tree has more than one
    node, every `FAN` consecutive ones become the digest of their digests, the last ones even if
    fewer. What remains is the tree's subroot; the subroots in the order of their trees (null
    first) become one root in the same way. `path` holds, from the leaf to the root, the digests
    left and right of the way. An empty table gives no rows.
    """

    def of_trees(subroots: DataFrame) -> DataFrame:
        each = subroots.select(
            F.lit(0).alias("tree"), F.col("tree").alias("id"), F.col("subroot").alias("digest"),
            F.struct("tree", "subroot").alias("load"),
        )
        top = grown(each, of_all)
        return top.select(
            "load.tree", F.struct("above.path", "load.subroot", "above.root").alias("above")
        )

    def of_all(root: DataFrame) -> DataFrame:
        start = F.struct(F.array().cast(f"array<{STEP}>").alias("path"), F.col("subroot"), F.col("subroot").alias("root"))
        return root.select("tree", start.alias("above"))

    return grown(leaves, of_trees).select("tree", "rank", "digest", "load", "above.subroot", "above.root", "above.path")


def proof_text(path: Column) -> Column:
    """The digests beside the way, left to right, level by level."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that `leaf` and the digests beside its way give."""
    return F.aggregate(path, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def audit(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: its leaf, proof and roots, and whether a later state of the table still proves.

    The later state lower-cases A-Z of the texts whose doc_id has a crc32 that 3 divides; a null
    doc_id is none of them. Nulls in any column, empty and very long texts have a leaf as any other
    row. Repeated rows are leaves side by side. Further columns are not looked at.
    """
    tampered = F.when(remainder(F.col("doc_id"), 3) == 0, document_digest(ascii_lower(F.col("text"))))
    leaf = document_digest(F.col("text"))
    read = docs.select(
        F.col("lang").alias("tree"), F.col("doc_id").cast("long").alias("id"), leaf.alias("digest"),
        F.when(F.col("doc_id").isNotNull(), tampered).alias("load"),
    )
    found = manifest(stored(read).withColumn("load", F.struct("id", F.coalesce("load", "digest").alias("now"))))
    return found.select(
        F.col("load.id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        digest(proof_text(F.col("path"))).alias("proof_sha256"), folded(F.col("load.now"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
