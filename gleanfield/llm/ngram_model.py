"""Language-model scores from log-frequency Bloom filters of quantised n-gram counts.

A count is quantised on a logarithmic scale; an n-gram of level q is put into the filter q times, each
time together with a level from 1 to q. Asking for level 1, 2, ... until one is
missing gives the level back, never too low, seldom too high.

    P(w | v) = (c(v w) + MU * P(w)) / (c(v) + MU),    P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1))

Every word and every pair of the training texts counts, however rare, so what is held grows with the corpus.
Common words and very common pairs, of which there is a bounded number at any size, are in one filter
that all workers get. All else is in shards: a document's pairs go to the shard of their second
word, which counts them, fills its filter, asks it and sends back a sum per document. As the words before the words
of a text are its own words once more, the sum over c(v) + MU is one over c(w) + MU, so a shard needs no
other word's count. Pairs of a common second word, whose count all workers have, are spread by the whole pair.
The end of a text is a word too, and the word before a text's first is that end.
"""

import itertools
import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanfield.llm.common import remainder, short_batches, stored

END = b""  # no word is empty
STEP = 2**0.25  # ratio of neighbouring levels
HASHES, BITS_PER_ENTRY = 6, 10
MU = 1000.0  # weight of a word's own frequency against what followed the word before it
# Words at hand in each task make up at least COMMON of the training tokens each, so there are at most
# 1 / COMMON, and their levels together at most 1 / COMMON / (1 - 1 / STEP) entries. Pairs at hand make
# up HOT each and are made of words that make up TOP each.
COMMON, TOP, HOT = 1e-6, 1e-4, 1e-5
SHARD_TOKENS = 1 << 20
WORD, PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(0x165667B19E3779F9) + b)


@dataclass
class LogFrequencyFilter:
    least: float  # counts below are not held
    bits: np.ndarray = field(repr=False)  # of uint8, a power of two long

    @classmethod
    def build(cls, least: float, counted: list[tuple[np.uint64, np.ndarray, np.ndarray]]):
        """`counted` has (kind, keys, counts)."""
        held = [(mixed(keys ^ kind), cls.level_of(counts, least)) for kind, keys, counts in counted]
        entries = int(sum(levels.sum() for _, levels in held))
        size = 1 << max(10, (BITS_PER_ENTRY * entries).bit_length())
        filter_ = cls(least, np.zeros(size // 8, np.uint8))
        filled = np.zeros(size, bool)
        for keys, levels in held:
            for level in range(1, int(levels.max(initial=0)) + 1):
                for position in filter_.positions(keys[levels >= level], level):
                    filled[position] = True
        filter_.bits = np.packbits(filled, bitorder="little")
        return filter_

    @staticmethod
    def level_of(counts: np.ndarray, least: float) -> np.ndarray:
        return (np.log(np.maximum(counts, least) / least) / math.log(STEP) + 1e-9).astype(np.int64) + 1

    def positions(self, keys: np.ndarray, level: int):
        h = mixed(keys + np.uint64(level * 0x2545F4914F6CDD1D % 2**64))
        step = mixed(h) | np.uint64(1)
        size = np.uint64(len(self.bits) * 8 - 1)
        for i in range(HASHES):
            yield ((h + np.uint64(i) * step) & size).astype(np.int64)

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for position in self.positions(keys, level):
            at = position[found]
            found[found] = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found

    def levels(self, kind: np.uint64, keys: np.ndarray) -> np.ndarray:
        """Levels by repeated probes; 0 of what is not held."""
        keys = mixed(keys ^ kind)
        level = np.zeros(len(keys), np.int64)
        open_ = np.arange(len(keys))
        probe = 0
        while len(open_):
            probe += 1
            open_ = open_[self.has(keys[open_], probe)]
            level[open_] = probe
        return level

    def counts(self, kind: np.uint64, keys: np.ndarray) -> np.ndarray:
        """Estimated counts; 0 of what is not held."""
        return count_of(self.levels(kind, keys), self.least)


def count_of(level: np.ndarray, least: float) -> np.ndarray:
    """The middle of a level's range, which is a single count while steps are shorter than 1."""
    low = least * STEP ** (level.astype(np.float64) - 1)
    first, last = np.ceil(low - 1e-9), np.ceil(low * STEP - 1e-9) - 1
    return np.where(level > 0, np.sqrt(np.maximum(first, 1) * np.maximum(last, np.maximum(first, 1))), 0.0)


def tokens(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All tokens, each text's words and its END, and the number of each text's tokens."""
    split = [t.lower().split() for t in texts]
    for words in split:
        words.append(END)
    return list(itertools.chain.from_iterable(split)), np.fromiter(map(len, split), np.int64, len(split))


def training(docs: DataFrame, held_out: tuple[int, int]) -> DataFrame:
    learned = remainder(F.col("doc_id"), held_out[0]) != held_out[1]
    return docs.where(learned).select(F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def text_slices(texts: list[bytes], most: int = 2 << 20):
    """Texts in lists of about `most` bytes: a slice's tokens and what is said of them take some 30 times that."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > most:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def vocabulary(train: DataFrame) -> DataFrame:
    """token and its count n in all training texts, summed within a task first."""

    def compute(batches):
        held = Counter()
        for batch in batches:
            for some in text_slices([t or b"" for t in batch.column(0).to_pylist()]):
                held.update(tokens(some)[0])
                if len(held) > 200_000:
                    yield from out(held)
                    held = Counter()
        yield from out(held)

    def out(held):
        names, n = list(held), list(held.values())
        for i in range(0, len(names), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(names[i : i + 100_000], pa.binary()), pa.array(n[i : i + 100_000], pa.int64())], names=["token", "n"])

    short_batches(train.sparkSession)
    return train.mapInArrow(compute, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Words:
    """What is known of a task's words, each distinct word looked up once.

    `columns` has the words' hashes and what `describe` says of the words and hashes; the
    cache starts anew above 200,000 words.
    """

    def __init__(self, describe):
        self.describe = describe
        self.clear()

    def clear(self):
        none = np.empty(0, np.uint64)
        self.index, self.columns = {}, [none, *self.describe([], none)]

    def of(self, flat: list[bytes]) -> np.ndarray:
        """Places of `flat` in the columns."""
        if len(self.index) > 200_000:
            self.clear()
        new = list(set(flat).difference(self.index))
        if new:
            self.index.update(zip(new, itertools.count(len(self.index))))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
            self.columns = [np.concatenate(x) for x in zip(self.columns, [hashes, *self.describe(new, hashes)])]
        return np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))


def with_previous(place: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([[end], place[:-1]]), place


def top_pairs(train: DataFrame, names: list[bytes], hashes: np.ndarray) -> DataFrame:
    """key and n of the pairs that two of the words `names` make, summed within a task first."""
    shared = train.sparkSession.sparkContext.broadcast((dict(zip(names, itertools.count())), hashes))

    def compute(batches):
        index, _ = shared.value
        pairs, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            for some in text_slices([t or b"" for t in batch.column(0).to_pylist()]):
                flat, _ = tokens(some)
                place = np.fromiter(map(index.get, flat, itertools.repeat(-1)), np.int64, len(flat))
                a, b = with_previous(place, index.get(END, -1))
                both = (a >= 0) & (b >= 0)
                more, times = np.unique(a[both] << 32 | b[both], return_counts=True)
                pairs, where = np.unique(np.concatenate([pairs, more]), return_inverse=True)
                n = np.bincount(where, np.concatenate([n, times]), len(pairs)).astype(np.int64)
                if len(pairs) > 500_000:
                    yield out(pairs, n)
                    pairs, n = pairs[:0], n[:0]
        yield out(pairs, n)

    def out(pairs, n):
        _, hashes = shared.value
        keys = pair_key(hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF])
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    short_batches(train.sparkSession)
    return train.mapInArrow(compute, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """What all workers have: common words and pairs in the filter, and common words exactly for the base score."""

    filter: LogFrequencyFilter
    exact: dict[bytes, int]
    tokens: int
    distinct: int

    def cache(self) -> Words:
        """Words with their levels, and log10(c + 0.5) by their exact counts, NaN of those not common."""

        def describe(names, hashes):
            exact = np.fromiter((self.exact.get(name, -1) for name in names), np.int64, len(names))
            return [self.filter.levels(WORD, hashes), np.where(exact < 0, np.nan, np.log10(np.maximum(exact, 0) + 0.5))]

        return Words(describe)

    def share(self, count: np.ndarray) -> np.ndarray:
        """P(w) of a word counted so often."""
        return (count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))


def learn(docs: DataFrame, held_out: tuple[int, int]) -> tuple[Model, DataFrame]:
    train = training(docs, held_out)
    counts = stored(vocabulary(train))
    got = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = got["n"] or 0, got["v"]
    least = max(1.0, COMMON * total)
    kept = counts.where(F.col("n") >= least).toArrow()  # at most 1 / COMMON rows
    names, n = kept.column("token").to_pylist(), kept.column("n").to_numpy()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))
    words = LogFrequencyFilter.build(least, [(WORD, hashes, n)])
    top = words.counts(WORD, hashes) >= TOP * total
    pairs = top_pairs(train, [names[i] for i in np.flatnonzero(top)], hashes[top])
    pairs = pairs.where(F.col("n") >= max(least, HOT * total)).toArrow()  # at most 1 / HOT rows
    keys, pair_n = pairs.column("key").to_numpy().view(np.uint64), pairs.column("n").to_numpy()
    whole = LogFrequencyFilter.build(least, [(WORD, hashes, n), (PAIR, keys, pair_n)])
    exact = dict(zip(names, n.tolist()))
    return Model(whole, exact, int(total), int(distinct)), counts


# Rows between tasks: to the shards (kind 0 pairs of common second words, 1 of others, 2 a slice's documents), and back.
SENT = "shard long, slice long, kind int, low binary, high binary, level binary, doc binary, word binary, docs binary"
BACK = "slice long, shard long, doc binary, sums binary, docs binary"
TRAINED = np.uint16(1 << 15)
RARE_TYPE = pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int32())]))


def rows_of(schema: str, rows: list[dict]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_pylist(rows, pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]))


def base_of(cache: Words, place: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """For each text, whose words are at `place` in the cache: the exact sum over its common words, their number, and its other words."""
    base = cache.columns[2][place]
    rare = np.isnan(base)
    starts = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)[rare]
    met, n = np.unique(of << np.uint64(32) | place[rare].astype(np.uint64), return_counts=True)
    cuts = np.searchsorted(met >> np.uint64(32), np.arange(len(sizes) + 1, dtype=np.uint64))
    names = list(cache.index)
    words = pa.array([names[i] for i in (met & np.uint64(0xFFFFFFFF)).tolist()], pa.binary())
    listed = pa.StructArray.from_arrays([words, pa.array(n.astype(np.int32))], fields=list(RARE_TYPE.value_type))
    others = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), listed, type=RARE_TYPE)
    return np.add.reduceat(np.where(rare, 0.0, base), starts), np.add.reduceat(~rare, starts, dtype=np.int64), others


def pairs_of(model: Model, cache: Words, texts: list[bytes], trained: np.ndarray, top: float):
    """The places of some texts' tokens and their numbers, what of each score needs no shard, and the pairs for the shards:
    second word's level (0 of a rare one) and hash, the pair's hash, and the document."""
    flat, sizes = tokens(texts)
    place = cache.of(flat)
    hashes, level, _ = cache.columns
    before, _ = with_previous(place, cache.index[END])
    doc = np.repeat(np.arange(len(texts)), sizes).astype(np.uint16)
    count = count_of(level, model.filter.least)
    common = level > 0
    local = np.where(common, -np.log10(count + MU), 0.0)[place]
    keys = pair_key(hashes[before], hashes[place])
    asked = np.flatnonzero((count[before] >= top) & (count[place] >= top) & common[before] & common[place])
    distinct, where = np.unique(keys[asked], return_inverse=True)
    known = model.filter.counts(PAIR, distinct)[where]
    held = asked[known > 0]
    local[held] += np.log10(known[known > 0] + MU * model.share(count[place[held]]))
    ends = np.cumsum(sizes)
    sums = np.add.reduceat(local, ends - sizes)
    open_ = np.ones(len(flat), bool)
    open_[held] = False
    doc = doc | np.where(trained, TRAINED, np.uint16(0))[doc]
    return place, sizes, sums, (level[place][open_].astype(np.uint8), hashes[place][open_], keys[open_], doc[open_])


def sent_rows(model: Model, cache: Words, ids: pa.Array, texts: list[bytes], trained: np.ndarray, top: float, number: int, shards: int) -> pa.RecordBatch:
    """The rows of SENT of the slice `number`. What it is made of is let go before the next slice."""
    place, sizes, sums, sent = pairs_of(model, cache, texts, trained, top)
    base, seen, rare = base_of(cache, place, sizes)
    table = pa.table(
        [ids, pa.array(sizes, pa.int64()), pa.array(seen), pa.array(base), pa.array(sums), rare],
        names=["doc_id", "n_tokens", "seen", "base", "score", "rare"],
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    own = {"shard": number * 2654435761 % 2**32 % shards, "slice": number, "kind": 2, "docs": sink.getvalue().to_pybytes()}
    return rows_of(SENT, [own, *packed(number, *sent, shards)])


def packed(number: int, level: np.ndarray, word: np.ndarray, key: np.ndarray, doc: np.ndarray, shards: int):
    """A row per shard, its pairs in the order of their hashes."""
    spread = np.where(level > 0, key, mixed(word)) >> np.uint64(64 - shards.bit_length() + 1)
    for kind, own in enumerate((level > 0, level == 0)):
        order = np.flatnonzero(own)
        rest = key[order] & np.uint64((1 << 40) - 1)
        order = order[np.argsort(spread[order] << np.uint64(40) | rest)]  # of 2^24 shards at most
        cuts = np.flatnonzero(np.diff(spread[order], prepend=-1)).tolist() if len(order) else []
        for a, z in zip(cuts, [*cuts[1:], len(order)]):
            at = order[a:z]
            columns = {"low": key[at].astype(np.uint32), "high": (key[at] >> np.uint64(32)).astype(np.uint8), "doc": doc[at]}
            columns |= {"word": word[at]} if kind else {"level": level[at]}
            yield {"shard": int(spread[at[0]]), "slice": number, "kind": kind} | {n: c.tobytes() for n, c in columns.items()}


def score(docs: DataFrame, held_out: tuple[int, int] = (5, 1)) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per row of `docs` (doc_id, text).

    Learns from the rows whose crc32(doc_id) modulo `held_out[0]` is not
    `held_out[1]`. base_score is exact: counts of common words are at hand in each task, those of
    the rest are joined. score is the model's, from the filters alone.

    A null text counts as empty, which has the one token of its end. A null
    doc_id stays null; repeated rows get a row each; an empty table gives no
    rows. Without training text no token is known and every word has the same probability.
    """
    spark = docs.sparkSession
    model, counts = learn(docs, held_out)
    shared = spark.sparkContext.broadcast(model)
    top = TOP * model.tokens
    shards = 1 << max(8, (model.tokens // SHARD_TOKENS).bit_length())

    def send(batches):
        own = shared.value
        cache = own.cache()
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            ids, trained = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            at = 0
            for some in text_slices([t or b"" for t in batch.column(1).to_pylist()]):
                m = len(some)
                yield sent_rows(own, cache, ids[at : at + m], some, trained[at : at + m], top, number, shards)
                at, number = at + m, number + 1
            pa.default_memory_pool().release_unused()

    def answer(_, rows):
        own, kinds = shared.value, rows.column("kind").to_numpy()
        answers, parts = [], []

        def column(name, kind, at):
            return np.concatenate([np.empty(0, kind), *[np.frombuffer(x, kind) for x in at.column(name).to_pylist()]])

        for kind in (0, 1):
            at = rows.filter(pa.array(kinds == kind))
            key = column("high", np.uint8, at).astype(np.uint64) << np.uint64(32) | column("low", np.uint32, at)
            doc = column("doc", np.uint16, at)
            times = [len(x) // 2 for x in at.column("doc").to_pylist()]
            slice_ = np.repeat(at.column("slice").to_numpy(), times)
            trained = (doc & TRAINED) > 0
            pairs, where = np.unique(key, return_inverse=True)
            seen = np.bincount(where[trained], minlength=len(pairs))
            counted = [(PAIR, pairs[seen > 0], seen[seen > 0])]
            if kind:
                words, of = np.unique(column("word", np.uint64, at), return_inverse=True)
                met = np.bincount(of[trained], minlength=len(words))
                counted.append((WORD, words[met > 0], met[met > 0]))
            held = LogFrequencyFilter.build(1.0, counted)
            found = held.counts(PAIR, pairs)[where]
            if kind:
                count = held.counts(WORD, words)[of]
                logs = np.log10(found + MU * own.share(count)) - np.log10(count + MU)
            else:
                count = count_of(column("level", np.uint8, at), own.filter.least)
                logs = np.log10(found + MU * own.share(count))
            parts.append((slice_, doc & ~TRAINED, logs))
        slice_, doc, logs = (np.concatenate(x) for x in zip(*parts))
        names, where = np.unique(slice_, return_inverse=True)
        cells, of = np.unique(where.astype(np.uint64) << np.uint64(16) | doc, return_inverse=True)
        sums = np.bincount(of, logs, len(cells)).astype(np.float32)
        doc = (cells & np.uint64(0xFFFF)).astype(np.uint16)
        cuts = np.searchsorted((cells >> np.uint64(16)).astype(np.int64), np.arange(len(names) + 1)).tolist()
        shard = rows.column("shard")[0].as_py()
        for name, a, z in zip(names.tolist(), cuts, cuts[1:]):
            answers.append({"slice": name, "shard": shard, "doc": doc[a:z].tobytes(), "sums": sums[a:z].tobytes()})
        for row in rows.filter(pa.array(kinds == 2)).select(["slice", "docs"]).to_pylist():
            answers.append(row | {"shard": -1})
        return pa.Table.from_batches([rows_of(BACK, answers)])

    def total(_, rows):
        rows = sorted(rows.to_pylist(), key=lambda r: r["shard"])  # sums in one order, whatever the shards'
        table = pa.ipc.open_stream(rows[0]["docs"]).read_all()
        score = table.column("score").to_numpy().copy()
        for r in rows[1:]:
            score[np.frombuffer(r["doc"], np.uint16)] += np.frombuffer(r["sums"], np.float32)
        row = (rows[0]["slice"] << 16) + np.arange(len(table))
        table = table.set_column(table.column_names.index("score"), "score", pa.array(score))
        return table.add_column(0, "row", pa.array(row))

    short_batches(spark)
    trained = remainder(F.col("doc_id"), held_out[0]) != held_out[1]
    sent = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), trained).mapInArrow(send, SENT)
    first = stored(
        sent.groupBy("shard").applyInArrow(answer, BACK).groupBy("slice").applyInArrow(
            total, "row long, doc_id long, n_tokens long, seen long, base double, score double, rare array<struct<token: binary, n: int>>"
        )
    )
    rare = first.select("row", F.explode("rare").alias("x")).select("row", "x.token", F.col("x.n").alias("times"))
    found = rare.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("base_rare"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("seen_rare"),
    )
    each = math.log10(model.tokens + 0.5 * (model.distinct + 1))
    return first.drop("rare").join(found, "row", "left").select(
        "doc_id", (remainder(F.col("doc_id"), held_out[0]) == held_out[1]).alias("held_out"), "n_tokens",
        (F.col("seen") + F.coalesce("seen_rare", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rare", F.lit(0.0)) - F.col("n_tokens") * each).alias("base_score"), "score",
    )
