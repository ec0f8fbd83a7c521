"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. Texts become sets of word shingles; equal sets are one class from then on.
2. Each class has one entry per tree: its first `depth` MinHash values in that tree's order. All
   entries are sorted. Classes that share them form a region, in which pairs whose signatures look
   similar are connected. Where more than `region` classes of a region are not yet connected with its
   others, all its members are dealt anew by more values, in as many more trees as it takes
   for the same chance to meet; at the last level all pairs that are left are compared.
3. Connected classes are a cluster: every link between different texts lies within one, but not all
   of a cluster need be linked. Links are decided on the full sets.

A pair at similarity s shares a region in one of the trees with probability
1 - (1 - s^depth)^trees: 0.99999 at 0.8 with the defaults, and with as much at each of the deeper levels.
"""

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanfield.llm.common import short_batches, stored

TREES, VALUES = 16, 8  # values of 16 bits in each tree's order
DEEPER = (5, 8, 12)  # values in a tree of the levels for large regions
SKETCH = 64  # bytes of the signature compared within a region
# Sketches of 64 values agree in 0.8 +- 0.05 of them at a similarity of 0.8; 0.575 is 4.5 deviations below.
LOOKS_SIMILAR = 0.575
# Clusters above either are verified by several tasks, in blocks of BLOCK_ROWS texts.
GIANT_ROWS, GIANT_BYTES, BLOCK_ROWS = 2000, 32 << 20, 250

_rng = np.random.default_rng(8)
MULTIPLY = _rng.integers(1, 2**63, TREES * VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 2**63, TREES * VALUES, dtype=np.uint64)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Shingles:
    """Sets of `width`-word shingles as sorted 64-bit hashes; A-Z are lower-cased."""

    def __init__(self, width: int):
        self.width, self.words = width, {}

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if len(self.words) > 200_000:
            self.words.clear()
        known, get = self.words, self.words.get
        hashes = []
        for word in words:
            h = get(word)
            if h is None:
                h = known[word] = xxhash.xxh3_64_intdigest(word)
            hashes.append(h)
        width = min(self.width, len(words))
        if not width:
            return np.empty(0, np.uint64)
        flat = np.array(hashes, np.uint64)
        n = len(flat) - width + 1
        out = np.full(n, width, np.uint64)
        for j in range(width):
            out = mixed(out * SPREAD + flat[j : j + n])
        return np.unique(out)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """TREES * VALUES values of 16 bits."""
    least = np.full(len(MULTIPLY), np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 2048):
        part = shingles[i : i + 2048]
        np.minimum(least, (MULTIPLY[:, None] * part + ADD[:, None]).min(1), out=least)
    return (mixed(least) >> np.uint64(48)).astype(">u2")


def class_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, a hash of the text, n_shingles, class (null for an empty set), the values,
    and as sketch the lower bytes of the first SKETCH values."""

    def compute(batches):
        shingles = Shingles(shingle)
        for batch in batches:
            sizes, names, values, sketches = [], [], [], []
            for text in batch.column(1).to_pylist():
                held = shingles.of(text or b"")
                sizes.append(len(held))
                names.append(class_of(held) if len(held) else None)
                found = minhash(held).tobytes() if len(held) else None
                values.append(found)
                sketches.append(found and found[1 : 2 * SKETCH : 2])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()),
                    pa.array(values, pa.binary()), pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "class", "values", "sketch"],
            )

    short_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), text_hash()).mapInArrow(
        compute, "doc_id long, text_hash long, n_shingles long, class long, values binary, sketch binary"
    )


def text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string")).alias("text_hash")


def similar_groups(sketch: np.ndarray) -> np.ndarray:
    """For each row of `sketch` the first row it is connected with by rows that look similar."""
    n = len(sketch)
    near = np.empty((n, n), bool)
    for i in range(0, n, 64):
        near[i : i + 64] = (sketch[i : i + 64, None] == sketch[None]).mean(2) >= LOOKS_SIMILAR
    label = np.arange(n)
    while True:
        new = np.where(near, label[None], n).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def trees_at(depth: int) -> int:
    """How many random choices of `depth` of all values it takes for a pair at a similarity of 0.8 to agree in one
    of them with probability 0.99999."""
    held, trees = TREES * VALUES, TREES
    chances = [math.comb(held, a) * 0.8**a * 0.2 ** (held - a) for a in range(held + 1)]
    agree = [math.comb(a, depth) / math.comb(held, depth) for a in range(held + 1)]
    while sum(c * (1 - g) ** trees for c, g in zip(chances, agree)) > 1e-5:
        trees = math.ceil(trees * 1.05)
    return trees


def entries_of(classes: DataFrame, depth: int) -> DataFrame:
    """tree, key, class and sketch: for each class its key, `depth` random values, in each of `trees_at(depth)` trees."""
    rng = np.random.default_rng(depth)
    chosen = np.array([rng.permutation(TREES * VALUES)[:depth] for _ in range(trees_at(depth))])

    def compute(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            values = fixed(table.column("values"), 2 * TREES * VALUES).view(">u2").reshape(-1, TREES * VALUES)
            for tree, places in enumerate(chosen):
                keys = np.ascontiguousarray(values[:, places])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), tree)), pa.array([k.tobytes() for k in keys], pa.binary()), batch.column(0), batch.column(1)],
                    names=["tree", "key", "class", "sketch"],
                )

    return classes.select("class", "sketch", "values").mapInArrow(compute, "tree long, key binary, class long, sketch binary")


def region_links(entries: DataFrame, region: int) -> DataFrame:
    """Of `entries` (tree, key, class, sketch): rows with `mate`, a class that looks similar, and rows without one, the
    members of open regions.

    Entries are dealt by ranges of their order, so a region of any size spreads over tasks. A region of at most
    `region` classes within a task is compared whole. All others, and those that a range may cut, are open:
    they are compared in pieces here, and their members are given out too.
    """
    order = F.xxhash64("class", "tree")
    entries = entries.withColumn("turn", order).repartitionByRange("tree", "key", "turn").sortWithinPartitions("tree", "key", "turn").drop("turn")

    def compute(batches):
        rest, opened = None, True  # a task's first region may have begun in another
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            cuts = starts(table)
            yield from out(table, cuts, opened)
            if len(cuts) > 1:
                opened = False
            rest = table.slice(cuts[-1])
            while rest.num_rows > 4 * region:  # a part of a long one
                yield from out(rest.slice(0, region), [0, region], True)
                rest, opened = rest.slice(region), True
        if rest is not None:
            yield from out(rest, [0, rest.num_rows], True)

    def starts(table):
        tree, key = (table.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "key"))
        new = (tree[1:] != tree[:-1]) | (key[1:] != key[:-1])
        return [0, *(np.flatnonzero(new) + 1).tolist()]

    def out(table, cuts, opened):
        sketch = fixed(table.column("sketch"), SKETCH).reshape(-1, SKETCH)
        names = table.column("class").to_numpy()
        at, mates, members = [], [], []
        for a, b in itertools.pairwise(cuts):
            if opened or b - a > region:
                members.append(np.arange(a, b))
            opened = False
            for c in range(a, b, region) if b - a > 1 else ():
                groups = similar_groups(sketch[c : min(b, c + region)])
                joined = np.flatnonzero(groups != np.arange(len(groups)))
                at.append(c + joined)
                mates.append(names[c + groups[joined]])
        if at:
            links = table.take(np.concatenate(at)).append_column("mate", pa.array(np.concatenate(mates), pa.int64()))
            yield from links.combine_chunks().to_batches()
        if members:
            rows = table.take(np.concatenate(members))
            rows = rows.append_column("mate", pa.nulls(rows.num_rows, pa.int64()))
            yield from rows.combine_chunks().to_batches()

    entries.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    return entries.mapInArrow(compute, "tree long, key binary, class long, sketch binary, mate long")


def asked_links(rows: DataFrame) -> DataFrame:
    """Links (a, b) between what asks and the members it looks similar to, within `rows` (tree, key, block, ask,
    component, class, sketch): one to each component of a block, which then are one."""
    rows = rows.repartition("tree", "key", "block").sortWithinPartitions("tree", "key", "block", "ask")

    def compute(batches):
        at, held, sketch, label = None, [], None, None
        for batch in batches:
            found = []
            for tree, key, block, ask, component, name, own in zip(*(x.to_pylist() for x in batch.columns)):
                if (tree, key, block) != at:
                    at, held, sketch = (tree, key, block), [], None
                if not ask:
                    held.append((name, component, own))
                elif held:
                    if sketch is None:
                        sketch = np.frombuffer(b"".join(x for _, _, x in held), np.uint8).reshape(-1, SKETCH)
                        label = np.unique([c for _, c, _ in held], return_inverse=True)[1]
                    hit = np.flatnonzero((sketch == np.frombuffer(own, np.uint8)).mean(1) >= LOOKS_SIMILAR)
                    groups, first = np.unique(label[hit], return_index=True)
                    found += [(name, held[hit[i]][0]) for i in first if held[hit[i]][0] != name]
                    if len(groups) > 1:
                        label[np.isin(label, groups)] = groups[0]
            if found:
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return rows.select("tree", "key", "block", "ask", "component", "class", "sketch").mapInArrow(compute, "a long, b long")


def grown(clusters: DataFrame, edges: DataFrame) -> DataFrame:
    """`clusters` (node, component) with those that `edges` (a, b) connect put together."""
    of = clusters.select(F.col("node").alias("at"), "component")
    for end in ("a", "b"):
        edges = edges.join(of.withColumnRenamed("at", end), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    moved = stored(components(edges))
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
    kept = clusters.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return stored(kept.unionByName(moved.join(clusters.select("node"), "node", "left_anti")))


def connected(classes: DataFrame, depth: int, region: int) -> DataFrame:
    """node and component of the classes that look similar to another, directly or by others.

    Within a region only classes of different components are left to compare. In an open region, if at most
    `region` classes are not of its main component, they are compared with all. The members of other open regions
    go to a level of its own with more values and as many more trees as keep what two copies have to
    meet in; at the last level all that are not of the main component are compared with all.
    """
    size = 2 * VALUES
    trees = F.explode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(
        t.cast("long").alias("tree"), F.substring("values", t * size + 1, F.lit(2 * depth)).alias("key"))))
    entries = classes.select("class", "sketch", trees.alias("at")).select("at.tree", "at.key", "class", "sketch")
    clusters = None
    deeper = [d for d in DEEPER if d > depth]
    while True:
        found = stored(region_links(entries, region))
        mates = found.where("mate is not null").select(F.greatest("class", "mate").alias("a"), F.least("class", "mate").alias("b")).distinct()
        clusters = stored(components(mates)) if clusters is None else grown(clusters, mates)
        members = found.where("mate is null").drop("mate").join(
            clusters.select(F.col("node").alias("class"), "component"), "class", "left"
        ).withColumn("component", F.coalesce("component", "class"))
        counts = members.groupBy("tree", "key", "component").agg(F.count(F.lit(1)).alias("n"))
        regions = counts.groupBy("tree", "key").agg(
            F.sum("n").alias("all"), F.max("n").alias("most"), F.max_by("component", F.struct("n", "component")).alias("main")
        ).where(F.col("all") > F.col("most"))
        left = stored(members.join(regions, ["tree", "key"]))
        if not left.limit(1).count():
            return clusters
        few = F.col("all") - F.col("most") <= region if deeper else F.lit(True)
        near = left.where(few)
        blocks = F.ceil(F.col("all") / region)
        inside = near.withColumn("block", F.pmod(F.xxhash64("class"), blocks)).withColumn("ask", F.lit(False))
        asking = near.where("component <> main").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).withColumn("ask", F.lit(True))
        clusters = grown(clusters, stored(asked_links(inside.unionByName(asking)).distinct()))
        if not deeper:
            return clusters
        far = stored(left.where(~few).select("class").distinct())
        if not far.limit(1).count():
            return clusters
        entries = entries_of(classes.join(far, "class", "left_semi"), deeper.pop(0))


def fixed(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of `edges` (a > b).

    Large-star and small-star rounds: every node's neighbours are joined to its
    smallest one, until all edges lead to the smallest node. Hot nodes are only
    ever aggregated or joined, never gathered.
    """
    edges = stored(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = stored(large)
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = stored(small.unionByName(least.select("a", F.col("low").alias("b"))).distinct())
        # finished when each node has one edge and no target has an edge of its own
        more = small.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        if not more and not small.join(small.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count():
            break
        edges = small
    nodes = small.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())


def linked(shared: np.ndarray, size: int, sizes: np.ndarray, percent: int) -> np.ndarray:
    return (100 * shared >= percent * (size + sizes - shared)) & (shared > 0)


class SetLinks:
    """Exact links among sets of shingles held in one task."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.flat = np.concatenate(sets)
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        at = np.searchsorted(shingles, self.flat)
        at[at == len(shingles)] = 0
        shared = np.bincount(self.owner[shingles[at] == self.flat], minlength=len(self.sets))
        return np.flatnonzero(linked(shared, len(shingles), self.sizes, self.percent))

    def groups(self) -> np.ndarray:
        """For each set the smallest position it is linked with, directly or by others.

        Two sets that were both never compared with all others lie in the group of one
        same set, so no link between groups is missed.
        """
        n = len(self.sets)
        label = np.arange(n)
        tried = sorted({0, n // 2, n - 1})

        def compare(i):
            found = np.append(self.of(self.sets[i]), i)
            old = np.unique(label[found])
            label[np.isin(label, old)] = old[0]

        for i in tried:
            compare(i)
        centre = max(tried, key=lambda i: int((label == label[i]).sum()))
        for i in range(n):
            if i not in tried and label[i] != label[centre]:
                compare(i)
        return label


def verified(members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """class and group of the classes of `members` (cluster, class, text), by links on full sets."""

    def decide(rows):
        links = SetLinks([s for _, s in rows], percent)
        names = np.array([name for name, _ in rows])
        return names, names[links.groups()]

    def compute(batches):
        shingles = Shingles(shingle)
        cluster, rows = None, {}
        names, groups = [], []

        def close():
            if rows:
                a, b = decide(list(rows.items()))
                names.append(a)
                groups.append(b)

        for batch in batches:
            for c, name, text in zip(*(x.to_pylist() for x in batch.columns)):
                if c != cluster:
                    close()
                    cluster, rows = c, {}
                held = shingles.of(text or b"")
                # another row with the id of a class may hold another text
                if name not in rows and len(held) and class_of(held) == name:
                    rows[name] = held
            if names:
                yield two_longs(names, groups)
                names, groups = [], []
        close()
        if names:
            yield two_longs(names, groups)

    ordered = members.select("cluster", "class", "text").repartition("cluster").sortWithinPartitions("cluster")
    short_batches(members.sparkSession)
    return ordered.mapInArrow(compute, "class long, group long")


def two_longs(names, groups):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(names), pa.int64()), pa.array(np.concatenate(groups), pa.int64())], names=["class", "group"]
    )


def verified_giants(members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """As `verified`, for clusters too large for a task.

    All members are compared with three of their cluster; then those not linked with the best
    of the three are compared with all members, block by block.
    """
    spark = members.sparkSession
    schema = "cluster long, class long, text binary, lead long, linked boolean"

    def against(batches):
        shingles = Shingles(shingle)
        lead_name, lead = None, None
        for batch in batches:
            c, name, text, other, other_text = (x.to_pylist() for x in batch.columns)
            flags = []
            for t, o, ot in zip(text, other, other_text):
                if o != lead_name:
                    lead_name, lead = o, shingles.of(ot or b"")
                held = shingles.of(t or b"")
                shared = len(np.intersect1d(held, lead, assume_unique=True))
                flags.append(bool(linked(np.array([shared]), len(lead), np.array([len(held)]), percent)[0]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(flags)], names=["cluster", "class", "text", "lead", "linked"])

    short_batches(spark)
    order = F.xxhash64("class")
    picked = members.groupBy("cluster").agg(F.min_by("class", order).alias("x"), F.max_by("class", order).alias("y"), F.min_by("class", F.xxhash64("class", F.lit(1))).alias("z"))
    leads = picked.select("cluster", F.explode(F.array_distinct(F.array("x", "y", "z"))).alias("lead"))
    lead_text = members.select(F.col("cluster").alias("c2"), F.col("class").alias("lead"), F.col("text").alias("lead_text"))
    leads = leads.join(lead_text, "lead").select("cluster", "lead", "lead_text")
    compared = stored(
        members.join(leads, "cluster").select("cluster", "class", "text", "lead", "lead_text").mapInArrow(against, schema)
    )
    hits = compared.where("linked").select(F.col("class").alias("a"), F.col("lead").alias("b"))
    counts = compared.groupBy("cluster", "lead").agg(F.sum(F.col("linked").cast("long")).alias("n"), F.count(F.lit(1)).alias("rows"))
    best = counts.groupBy("cluster").agg(F.max_by("lead", F.struct("n", "lead")).alias("lead"), F.max("rows").alias("rows"))
    left = compared.join(best, ["cluster", "lead"])
    blocks = F.ceil(F.col("rows") / BLOCK_ROWS)
    # where all are linked with the best lead, there is nothing left to ask
    open_ = stored(left.where("not linked").select("cluster").distinct())
    left = left.join(open_, "cluster", "left_semi")
    members_of = left.select("cluster", "class", "text", F.pmod(F.xxhash64("class"), blocks).alias("block"), F.lit(False).alias("ask"), "linked")
    asking = left.where("not linked").select(
        "cluster", "class", "text", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), F.lit(True).alias("ask"), "linked"
    )

    def block_links(batches):
        """Of all links of an asking text one to each group of the block's members, which then are one group: a
        block gives no more links than it has texts."""
        shingles = Shingles(shingle)
        at, links, label = None, None, []
        sets, names, joined = [], [], []

        for batch in batches:
            found = []
            for c, block, ask, in_lead, name, text in zip(*(x.to_pylist() for x in batch.columns)):
                if (c, block) != at:
                    at, links = (c, block), None
                    sets, names, joined = [], [], []
                held = shingles.of(text or b"")
                if not ask:  # a block's members come first
                    sets.append(held)
                    names.append(name)
                    joined.append(in_lead)
                elif sets:
                    if links is None:
                        links = SetLinks(sets, percent)
                        # all members linked with the lead are one group
                        label = np.where(joined, -1, np.arange(len(names)))
                    hit = links.of(held)
                    groups, first = np.unique(label[hit], return_index=True)
                    found += [(name, names[hit[i]]) for i in first if names[hit[i]] != name]
                    label[np.isin(label, groups)] = groups[0] if len(groups) else 0
            if found:
                yield two_longs([[x for x, _ in found]], [[y for _, y in found]])

    asked = (
        members_of.unionByName(asking).select("cluster", "block", "ask", "linked", "class", "text")
        .repartition("cluster", "block").sortWithinPartitions("cluster", "block", "ask").mapInArrow(block_links, "class long, group long")
    )
    pairs = hits.unionByName(asked.select(F.col("class").alias("a"), F.col("group").alias("b"))).where("a <> b")
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return components(pairs).select(F.col("node").alias("class"), F.col("component").alias("group"))


def near_copies(
    docs: DataFrame, shingle: int = 2, percent: int = 80, depth: int = 3, region: int = 512
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept per row of `docs` (doc_id, text).

    Documents are linked when 100 * shared >= `percent` * all of their distinct
    `shingle`-word shingles after lower-casing A-Z; a text of fewer words is one shingle. component_id is
    the smallest doc_id reachable over links, kept says whether it is the row's own.

    A null text counts as empty; an empty text is linked with nothing. Equal texts
    are linked. Rows with a null doc_id take part in no link: their component_id is
    null and they are kept. Repeated rows have the same component. An empty
    table gives no rows; further columns are not looked at.
    """
    return judged(docs, shingle, percent, depth, region).drop("text_hash")


def judged(docs: DataFrame, shingle: int, percent: int, depth: int, region: int) -> DataFrame:
    """What `near_copies` tells, with each row's text_hash."""
    found = stored(signatures(docs, shingle))
    named = found.where("class is not null and doc_id is not null")
    classes = stored(
        named.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("values").alias("values"), F.first("sketch").alias("sketch"))
    )
    clusters = connected(classes, depth, region)
    # cluster sizes decide who verifies them
    grouped = clusters.join(classes.select(F.col("class").alias("node"), "doc_id"), "node").select(
        F.col("component").alias("cluster"), F.col("node").alias("class"), "doc_id"
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    members = stored(grouped.join(texts, "doc_id").select("cluster", "class", "text"))
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("bytes"))
    giants = stored(sizes.where((F.col("n") > GIANT_ROWS) | (F.col("bytes") > GIANT_BYTES)).select("cluster"))
    if giants.limit(1).count():
        rest = verified(members.join(giants, "cluster", "left_anti"), shingle, percent)
        decided = rest.unionByName(verified_giants(members.join(giants, "cluster", "left_semi"), shingle, percent))
    else:
        decided = verified(members, shingle, percent)
    decided = stored(decided)
    least = decided.join(classes.select("class", "doc_id"), "class").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    moved = decided.join(least, "group").select("class", "component_id")
    # stored, so that the last join is one that Spark may split where many documents are of one class
    whole = stored(
        classes.select("class", F.col("doc_id").alias("own")).join(moved, "class", "left").select(
            "class", F.coalesce("component_id", "own").alias("component_id")
        )
    )
    placed = found.select("doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class")).alias("class")).join(whole, "class", "left")
    component = F.coalesce("component_id", "doc_id")
    return placed.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_copies(docs: DataFrame, shingle: int = 2, percent: int = 80, depth: int = 3, region: int = 512) -> DataFrame:
    """`docs` with one document of each group of near copies, all columns as they were.

    A row goes by its id and text, so another text that shares the id of a copy stays.
    """
    dropped = judged(docs, shingle, percent, depth, region).where("not kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"))
    copy = (F.col("doc_id") == F.col("__id")) & (text_hash() == F.col("__text"))
    return docs.join(stored(dropped.distinct()), copy, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
