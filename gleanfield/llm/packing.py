"""Packing tokenised documents into sequences: shortest pack first over the length histogram."""

import itertools
import os
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanfield.llm.common import short_batches, stored

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, __part int, __rank long"
)
CACHED_WORDS = 500_000
SLICE_BYTES = 1 << 20  # of texts tokenised at once
CLOSING = b".,;:!?"


class Numbers(dict):
    """Words by number, in the order they are met; `new` has those met since it was last emptied."""

    def __init__(self, words=()):
        super().__init__(zip(words, itertools.count()))
        self.new = []

    def __missing__(self, word):
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordTokens:
    """Ids of texts, each distinct word tokenised once.

    The tokenizer never looks across white space nor lets case count, so ids of a text are those
    of its lower-case words. Above `CACHED_WORDS` words seen only once since the last time are
    forgotten; this changes no id.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a run of letters
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.index, self.ids = Numbers(), np.empty(0, np.uint32)
        # by number: where the word's ids are, and how often it was met
        self.starts, self.lengths, self.uses = (np.empty(0, np.int64) for _ in range(3))

    def forget(self):
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > CACHED_WORDS // 2:
            keep = np.sort(np.argsort(self.uses, kind="stable")[-CACHED_WORDS // 2 :])
        words = list(self.index)
        self.index = Numbers(words[i] for i in keep.tolist())
        self.ids = self.ids[spans(self.starts[keep], self.lengths[keep])]
        self.lengths = self.lengths[keep]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.uses = np.zeros(len(keep), np.int64)

    def learn(self):
        """Find the ids of new words. Closing marks after what stays a letter or digit for the tokenizer are tokens of
        their own, so such a word is looked up in two parts."""
        index, new = self.index, self.index.new
        first = len(index) - len(new)
        letters, others, parts, split = [], [], [], []
        for number, word in enumerate(new, first):  # parts met for the first time are appended on the way
            stem = word.rstrip(CLOSING)
            if len(stem) < len(word) and ends_plain(stem):
                split.append(number)
                parts += (index[stem], index[word[len(stem) :]])
            elif word.isalpha() or only_letters(word.decode()):
                letters.append(number)
            else:
                others.append(number)
        grown = len(index)
        starts, lengths = (np.concatenate([x, np.zeros(grown - first, np.int64)]) for x in (self.starts, self.lengths))
        held = [self.ids]
        end = len(self.ids)

        def add(numbers, flat, own):
            nonlocal end
            held.append(flat)
            lengths[numbers] = own
            starts[numbers] = end + np.cumsum(own) - own
            end += len(flat)

        for i in range(0, len(letters), 20_000):
            # words of letters only are told apart in one text by the ids that end them
            some = letters[i : i + 20_000]
            text = b" ".join([new[n - first] for n in some]).decode()
            flat = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.closes[flat])
            if len(ends) == len(some):
                add(some, flat, np.diff(ends, prepend=-1))
            else:  # a letter that the tokenizer takes for something else
                others += some
        for i in range(0, len(others), 20_000):
            some = others[i : i + 20_000]
            found = self.tokenizer.encode_batch([new[n - first].decode() for n in some], add_special_tokens=False)
            lists = [x.ids for x in found]
            own = np.fromiter(map(len, lists), np.int64, len(lists))
            add(some, np.fromiter(itertools.chain.from_iterable(lists), np.uint32, int(own.sum())), own)
        if split:
            known = np.concatenate(held)
            held = [known]
            part = np.array(parts)
            add(split, known[spans(starts[part], lengths[part])], lengths[part].reshape(-1, 2).sum(1))
        self.ids, self.starts, self.lengths = np.concatenate(held), starts, lengths
        self.uses = np.concatenate([self.uses, np.zeros(grown - first, np.int64)])
        index.new = []

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's ids end."""
        if len(self.index) > CACHED_WORDS:
            self.forget()
        # a special token is known by its exact letters
        words = [(t if b"<|" in t else t.lower()).split() for t in texts]
        flat = list(itertools.chain.from_iterable(words))
        where = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        if self.index.new:
            self.learn()
        self.uses += np.bincount(where, minlength=len(self.uses))
        lengths = self.lengths[where]
        ends = np.cumsum(lengths)
        last_word = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        return self.ids[spans(self.starts[where], lengths)], np.concatenate([[0], ends])[last_word]


def only_letters(word: str) -> bool:
    """Whether a word is one run of letters for the tokenizer, which composes and lower-cases it."""
    return word.isalpha() and unicodedata.is_normalized("NFC", word) and word.lower().isalpha()


def ends_plain(stem: bytes) -> bool:
    """Whether a word ends in a letter or digit that composing and lower-casing leave one.

    Letters beyond the Cyrillic ones are not asked for, as which they are differs between versions of Unicode.
    """
    if stem[-1:].isalnum():
        return True
    last = stem[-4:].decode(errors="ignore")[-1:].lower()
    return len(last) == 1 and last < "\u0530" and unicodedata.category(last)[0] in "LN" and unicodedata.is_normalized("NFC", last)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of ranges that begin at `starts`, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


_tokens: dict[str, WordTokens] = {}


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int) -> DataFrame:
    """One row per piece: each document's ids cut after every `size` of them.

    `__part` and `__rank` number the pieces of one length within a task.
    """

    def cut(batches):
        tokens = _tokens.setdefault(tokenizer, None) or WordTokens(tokenizer)
        _tokens[tokenizer] = tokens
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            rows = []
            # batches are cut by bytes, so that a worker's memory stays bounded
            for a, b in byte_slices(texts, SLICE_BYTES):
                ids, ends = tokens.encode(texts[a:b])
                ids = np.insert(ids, ends, end_id).astype("<u4")
                ends = ends + np.arange(1, b - a + 1)
                first = 0
                for doc_id, last in zip(doc_ids[a:b], ends.tolist()):
                    for start in range(first, last, size):
                        stop = min(start + size, last)
                        length = stop - start
                        crc = zlib.crc32(ids[start:stop].tobytes())
                        rows.append((doc_id, start - first, length, crc, last - first, part, seen[length]))
                        seen[length] += 1
                    first = last
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], names=NAMES
                )
        # the worker outlives the task, what its batches took should not
        pa.default_memory_pool().release_unused()

    short_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(cut, PIECES)


NAMES = [c.split()[0] for c in PIECES.split(", ")]
TYPES = [pa.int64()] * 5 + [pa.int32(), pa.int64()]


def byte_slices(texts: list[bytes], most: int):
    """Consecutive ranges of `texts` of about `most` bytes each; a longer text is a range of its own."""
    a = total = 0
    for b, t in enumerate(texts):
        if b > a and total + len(t) > most:
            yield a, b
            a, total = b, 0
        total += len(t)
    if a < len(texts):
        yield a, len(texts)


def pack_patterns(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """(count, lengths) of packs that hold every length of `histogram` as often as it occurs.

    Lengths are placed longest first, each into the shortest packs, a whole group of like packs at a
    time; a group is split where fewer pieces are left than packs. When the shortest pack is too
    long, as many packs are opened as the rest of all pieces needs beyond the room there is, but
    no more than pieces of this length are left. Work and result depend on the number of
    distinct lengths, at most `size`, not on the number of pieces.
    """
    room: list[list[tuple[int, list[int]]]] = [[] for _ in range(size + 1)]
    most, free = -1, 0
    rest = sum(length * n for length, n in histogram.items())
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while most >= 0 and not room[most]:
                most -= 1
            if most < length:
                take = max(1, min(left, -(-(rest - free) // size)))
                free += take * size
                count, lengths, most = take, [], size
            else:
                count, lengths = room[most].pop()
                take = min(count, left)
            if count > take:
                room[most].append((count - take, lengths))
            room[most - length].append((take, lengths + [length]))
            left -= take
            free -= take * length
            rest -= take * length
    return [group for groups in room for group in groups]


def slots(patterns: list[tuple[int, list[int]]]) -> np.ndarray:
    """Sorted rows (length, first rank, first sequence, offset): where ranks of a length go."""
    used, rows, sequence = Counter(), [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2) -> DataFrame:
    """Pack all of `docs` (doc_id, text) into sequences of at most `size` ids.

    Every document's ids, closed by `end_id`, are cut after each `size` ids;
    whole pieces are sequences of their own, the remainders are packed by
    `pack_patterns`. Returns doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id and offset per piece. Only the histogram of lengths, at most
    `size` rows, reaches the driver; what goes to the tasks is bounded by it too.

    A null or empty text has only `end_id`; a null doc_id stays null; repeated
    rows are packed each; an empty table gives no rows; further columns are
    not looked at.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer, size, end_id))
    by_part = cut.groupBy("__part", "length").agg(F.count(F.lit(1)).alias("__n"))
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    table = slots(pack_patterns(histogram, size))
    places = spark.sparkContext.broadcast(table)

    # rank among all pieces of a length: those of earlier parts, then the rank within the part
    earlier = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("__part", "length", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    ranked = cut.join(before, ["__part", "length"]).select(
        *NAMES[:5], (F.col("__before") + F.col("__rank")).alias("__rank")
    )

    def place(batches):
        rows = places.value
        key = rows[:, 0] << 48 | rows[:, 1]
        for batch in batches:
            rank = batch.column(5).to_numpy()
            length = batch.column(2).to_numpy()
            at = np.searchsorted(key, length << 48 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(rows[at, 2] + rank - rows[at, 1]), pa.array(rows[at, 3])],
                names=[*NAMES[:5], "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
