"""Removal of passages that an earlier document, or an earlier place of the same one, already holds.

A passage is a window of consecutive words. Whether it repeats is found by doubling: the
windows of half its length are compared first, and only those that occur twice are extended to
twice their length, up to the length asked for. Of the many short windows inside a long one, the
one with the smallest hash (the leftmost of equals) stands for it; equal windows choose alike, so
none is lost, and about a sixth of all places is compared at the first length.

Places that are compared go to shards by their hash. A task sends a hash once (once again if an
earlier place turns up) and answers its further places itself, so the most frequent passage is
about one entry per task in its shard.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanfield.llm.common import short_batches, stored

WINDOW = 20
SHARD_BYTES = 64 << 20
KEY_BITS = 26
NO_ID = -(2**63)
NAMES = ["shard", "kind", "h", "more", "doc_id", "key", "at"]
ENTRY = "shard long, kind int, " + ", ".join(f"{n} binary" for n in NAMES[2:])
CUT = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())])), pa.string()]
KINDS = [np.uint64, np.uint32, np.int64, np.int64, np.uint32]
# odd constants of the 64-bit mixes, fixed values
ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
MIX = [0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53]


class WordHash(dict):
    """64-bit hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    for factor in MIX:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def window_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """The hash of every `length` consecutive entries of `words`, longer ones from two halves."""
    if len(words) < length:
        return np.empty(0, np.uint64)
    if length % 2 == 0:
        half = window_hashes(words, length // 2, seed)
        return mixed(half[: len(words) - length + 1] * np.uint64(ODD[seed]) + half[length // 2 :])
    total, factor = np.zeros(len(words) - length + 1, np.uint64), 1
    for j in range(length):
        factor = factor * ODD[2 + seed] % 2**64
        total += words[j : len(words) - length + 1 + j] * np.uint64(factor)
    return mixed(total)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of every `width` consecutive values is, the leftmost of equals."""
    at, best, reach = np.arange(len(values)), values, 1
    while reach < width:
        shift = min(reach, width - reach)
        later = best[shift:] < best[:-shift]
        at = np.where(later, at[shift:], at[:-shift])
        best = np.where(later, best[shift:], best[:-shift])
        reach += shift
    return at


class Batch:
    """The words of some documents, one after the other."""

    def __init__(self, texts: list[str | None], hashes: WordHash):
        words = [(t or "").encode().split() for t in texts]
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.words = np.fromiter(
            (hashes[w] for some in words for w in some), np.uint64, int(self.sizes.sum())
        )

    def windows(self, window: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        """The start of every window within a document, and of the short one that stands for it."""
        if len(self.words) < window:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        past = np.repeat(self.first + self.sizes, self.sizes)
        starts = np.flatnonzero(np.arange(len(past)) + window <= past)
        return starts, leftmost_least(window_hashes(self.words, base), window - base + 1)[starts]

    def marked(self, places: pa.ListArray) -> np.ndarray:
        """True at the words `places` names by their position in each document."""
        counts = places.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        at = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.zeros(len(self.words) + 1, bool)
        out[np.repeat(self.first, counts) + at] = True
        return out


def extended(starts, short, base, length, window):
    """The windows of `length` that hold the short ones and lie within those that begin at `starts`."""
    if length == window:
        return starts
    size = base
    while size < length:
        short = np.where(short - size >= starts, short - size, short)
        size *= 2
    return short


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination begins in columns that are sorted alike."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def told(columns, last: bool):
    """Of places (h, more, doc_id, key, at): in order; the first of each window; whether each is answered.

    At the last length all but the earliest place of a window are answered; before it all
    places of a window with more than one.
    """
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    first = runs(*columns[:2])
    size = np.diff(np.append(first, len(order)))
    if not last:
        return columns, first, np.repeat(size > 1, size)
    return columns, first, np.logical_or.reduce([c != np.repeat(c[first], size) for c in columns[2:]])


class Sent:
    """Windows that a task met several times, with the earliest place it sent of each."""

    def __init__(self, most: int = 100_000):
        self.most, self.columns = most, [np.empty(0, k) for k in KINDS]

    def compared(self, heads) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each place: whether its window is here, sent from an earlier place, sent from the same place."""
        if not len(self.columns[0]):
            return (np.zeros(len(heads[0]), bool),) * 3
        at = np.minimum(np.searchsorted(self.columns[0], heads[0]), len(self.columns[0]) - 1)
        held = [c[at] for c in self.columns]
        here = level = (held[0] == heads[0]) & (held[1] == heads[1])
        earlier = np.zeros(len(at), bool)
        for old, new in zip(held[2:], heads[2:]):
            earlier |= level & (old < new)
            level = level & (old == new)
        return here, earlier, level

    def add(self, heads) -> None:
        if len(self.columns[0]) < self.most:
            joined = [np.concatenate([a, b]) for a, b in zip(self.columns, heads)]
            order = np.lexsort(joined[::-1])
            first = runs(joined[0][order])
            self.columns = [c[order][first] for c in joined]


def packed(shards: np.ndarray, kind: int, columns) -> pa.RecordBatch:
    """One row per shard, the columns of its places as bytes."""
    order = np.argsort(shards, kind="stable")
    first = runs(shards[order])
    offsets = np.append(first, len(shards)).astype(np.int32)

    def bytes_of(column):
        if column is None:
            return pa.array([b""] * len(first), pa.binary())
        ends = pa.py_buffer(offsets * np.int32(column.itemsize))
        return pa.Array.from_buffers(pa.binary(), len(first), [None, ends, pa.py_buffer(column[order].tobytes())])

    arrays = [pa.array(shards[order][first], pa.int64()), pa.array(np.full(len(first), kind, np.int32))]
    return pa.RecordBatch.from_arrays(arrays + [bytes_of(c) for c in columns], names=NAMES)


def unpacked(table: pa.Table, names: list[str], kind: int) -> list[np.ndarray]:
    rows = table.filter(pc.equal(table.column("kind"), kind))
    return [np.frombuffer(b"".join(rows.column(n).to_pylist()), KINDS[NAMES.index(n) - 2]) for n in names]


def compare(docs: DataFrame, shards: int, window: int, base: int, length: int) -> DataFrame:
    """doc_id, key and the places (word positions) whose window of `length` words is answered by `told`.

    `docs` has doc_id, key and text, and beyond the first length the places answered before.
    """
    last = length == window

    def places(batches):
        hashes, sent = WordHash(), Sent()
        for batch in batches:
            b = Batch(batch.column("text").to_pylist(), hashes)
            starts, short = b.windows(window, base)
            if length > base:
                kept = b.marked(batch.column("places"))[extended(starts, short, base, length // 2, window)]
                starts, short = starts[kept], short[kept]
            at = np.unique(extended(starts, short, base, length, window))
            if not len(at):
                continue
            doc = np.repeat(np.arange(len(b.sizes)), b.sizes)[at]
            nothing = np.zeros(len(at), np.int64)
            columns = [
                window_hashes(b.words, length)[at],
                window_hashes(b.words, length, 1)[at].astype(np.uint32) if last else nothing.astype(np.uint32),
                batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)[doc] if last else nothing,
                batch.column("key").to_numpy(zero_copy_only=False)[doc],
                (at - b.first[doc]).astype(np.uint32),
            ]
            columns, first, answered = told(columns, last)
            size = np.diff(np.append(first, len(answered)))
            heads = [c[first] for c in columns]
            here, earlier, same = sent.compared(heads)
            quiet = earlier | same if last else here
            if last:
                answered[first] |= earlier
            else:
                answered |= np.repeat(here, size)
            if answered.any():
                shard = np.full(int(answered.sum()), int(columns[3][0]) % shards)
                yield packed(shard, 1, [None, None, *[c[answered] for c in columns[2:]]])
            if not quiet.all():
                heads, size = [h[~quiet] for h in heads], size[~quiet]
                sent.add([h[size > 1] for h in heads])
                yield packed((heads[0] % np.uint64(shards)).astype(np.int64), 0, heads)

    def answers(_, table):
        columns, _, answered = told(unpacked(table, NAMES[2:], 0), last)
        found = [np.concatenate([c[answered], k]) for c, k in zip(columns[2:], unpacked(table, NAMES[4:], 1))]
        return pa.Table.from_batches([packed(np.mod(found[1], shards), 1, [None, None, *found])])

    def by_document(_, table):
        ids, keys, at = unpacked(table, NAMES[4:], 1)
        order = np.lexsort((at, ids, keys))
        ids, keys, at = ids[order], keys[order], at[order]
        first = runs(keys, ids)
        offsets = pa.array(np.append(first, len(keys)).astype(np.int32))
        found = [
            pa.array(keys[first]), pa.array(ids[first], mask=ids[first] == NO_ID),
            pa.ListArray.from_arrays(offsets, pa.array(at.astype(np.int32))),
        ]
        return pa.Table.from_arrays(found, names=["key", "doc_id", "places"])

    answered = docs.mapInArrow(places, ENTRY).groupBy("shard").applyInArrow(answers, ENTRY)
    return answered.groupBy("shard").applyInArrow(by_document, "key long, doc_id long, places array<int>")


def with_likely(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`docs` and whether its key may be among those of `found`.

    Told by `2 ** KEY_BITS` bits, 8 MB at any size of `found`: they spare texts the way to a join
    as long as most bits are free, and a key of `found` always has its bit set.
    """
    bit = F.pmod("key", F.lit(1 << KEY_BITS))
    bits = found.select(F.shiftright(bit, 15).alias("part"), (bit % 32768).alias("bit")).groupBy("part").agg(
        F.bitmap_construct_agg("bit").alias("bits")
    )
    joined = docs.withColumn("bit", bit).withColumn("part", F.shiftright("bit", 15)).join(F.broadcast(bits), "part", "left")
    place = F.col("bit") % 32768
    byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_ = F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2)) == 1
    return joined.withColumn("likely", F.coalesce(set_, F.lit(False))).drop("bit", "part", "bits")


def without(docs: DataFrame, window: int) -> DataFrame:
    """`docs` (doc_id, text, places) without the words of the windows that begin at `places`."""

    def cut(batches):
        for batch in batches:
            rows = []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
                words = (text or "").encode().split()
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, places or [], 1)
                np.add.at(edges, [p + window for p in places or []], -1)
                gone = np.concatenate([[False], np.cumsum(edges)[:-1] > 0, [False]])
                turns = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
                spans = [{"first": a, "past": z} for a, z in zip(turns[::2], turns[1::2])]
                ends = [0, *turns, len(words)]
                kept = [w for a, z in zip(ends[::2], ends[1::2]) for w in words[a:z]]
                rows.append((len(words), len(words) - len(kept), spans, b" ".join(kept).decode()))
            names = ["n_words", "n_removed", "spans", "text"]
            columns = dict(zip(names, zip(*rows))) if rows else dict.fromkeys(names, [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(list(columns[n]), t) for n, t in zip(names, CUT)]], names=["doc_id", *names]
            )

    return docs.mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, spans array<struct<first: int, past: int>>, text string"
    )


def drop_repeats(docs: DataFrame, window: int = WINDOW, lengths: int = 2) -> DataFrame:
    """One row per row of `docs` (doc_id, text): n_words, n_removed, spans (word ranges removed), text (words kept).

    Words are runs of anything but ASCII white space. A word goes if a window of `window` words that covers it
    begins earlier as well: in a document with a smaller doc_id, or earlier in the same one.
    Windows are judged on the texts as they come. `lengths` window lengths are compared, each
    twice the one before. A null text has no words, and one with fewer words than a window stays
    whole. A null doc_id is smaller than any other. Texts that share an id stand in the order of a hash;
    rows that repeat an id and a text each keep what the others keep. An empty table gives no
    rows; further columns are not looked at. Windows are told apart by 96 bits of hash.
    """
    if window % 2 ** (lengths - 1) or lengths < 2:
        raise ValueError("the window must be the first length doubled, once at least")
    spark = docs.sparkSession
    short_batches(spark)
    key = F.xxhash64(F.col("doc_id").cast("long"), "text")
    rows = docs.select(F.col("doc_id").cast("long"), key.alias("key"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHARD_BYTES + 1)
    base, asked = window >> (lengths - 1), rows
    for level in range(lengths):
        found = stored(compare(asked, shards, window, base, base << level))
        if found.isEmpty():  # no candidate survives
            return without(rows.withColumn("places", F.lit(None).cast("array<int>")), window)
        marked = with_likely(rows, found)
        asked = marked.where("likely").join(found.select("key", "places"), "key").select(*rows.columns, "places")
    repeated = marked.where("likely").join(
        found.withColumnRenamed("key", "its_key").withColumnRenamed("doc_id", "its_id"),
        (F.col("key") == F.col("its_key")) & F.col("doc_id").eqNullSafe(F.col("its_id")), "left",
    )
    clean = marked.where("not likely").withColumn("places", F.lit(None).cast("array<int>"))
    columns = ["doc_id", "text", "places"]
    return without(clean.select(*columns), window).unionByName(without(repeated.select(*columns), window))
