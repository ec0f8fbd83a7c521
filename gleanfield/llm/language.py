"""Language identification by n-gram filters that answer with a bitmask of languages.

One Bloom filter serves all languages: each of its slots holds a word of bits, one bit
slice per language. Setting an n-gram sets a language's bit in the n-gram's slots; the AND of
those slots names all languages that contain it. A text's n-grams vote by these masks, and
each language's count is corrected for the false positives its slice's fill leads to.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanfield.llm.common import remainder, short_batches, stored

SIZES = (2, 3, 4)
HASHES = 4
# A language holds an n-gram that makes up at least RATE of its n-grams of that size, and at least
# SHARE of the n-gram's highest rate in any language. So it holds at most 1 / RATE of each size.
RATE, SHARE = 2e-5, 0.15
UNKNOWN = "und"

_letters: dict[str, np.ndarray] = {}


def letters() -> np.ndarray:
    """For each code point whether it is a letter; made once per worker."""
    if "table" not in _letters:
        _letters["table"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters["table"]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the letter n-grams of `texts`, the text each is from, and whether a text has a letter.

    Words are runs of letters with a border on both sides; n-grams lie within a word and its borders.
    """
    # each text begins with a zero, and holds no other
    joined = "".join(["\x00" + t.replace("\x00", " ") for t in texts]) + "\x00"
    points = np.frombuffer(joined.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.cumsum(points == 0) - 1
    is_letter = letters()[points]
    has = np.zeros(len(texts), bool)
    has[owner[is_letter]] = True
    # one border between words
    keep = is_letter | np.concatenate([[True], is_letter[:-1]])
    points = np.where(is_letter, points, 0)[keep].astype(np.uint64)
    owner, is_letter = owner[keep], is_letter[keep]
    hashes, owners = [], []
    for n in SIZES:
        if len(points) < n:
            continue
        m = len(points) - n + 1
        h = np.full(m, n, np.uint64)
        inner = np.ones(m, bool)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + points[j : j + m] + np.uint64(1)
            if 0 < j < n - 1:
                inner &= is_letter[j : j + m]
        if n == 2:
            inner = is_letter[:m] | is_letter[1:]
        hashes.append(mixed(h[inner]))
        # the border before a word may stand at the end of the text before
        owners.append(np.where(is_letter[:m], owner[:m], owner[np.arange(m) + 1])[inner])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64), has
    return np.concatenate(hashes), np.concatenate(owners), has


def counted(docs: DataFrame) -> DataFrame:
    """lang, gram and n of `docs` (text, lang): n-grams are summed within a task before the shuffle."""

    def compute(batches):
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        rows = 0
        for batch in batches:
            texts, langs = (c.to_pylist() for c in batch.columns)
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(texts, langs):
                by_lang.setdefault(lang, []).append(text or "")
            for lang, own in by_lang.items():
                for some in slices(own):
                    grams, n = np.unique(ngrams([t for _, t in some])[0], return_counts=True)
                    held.setdefault(lang, []).append((grams, n))
                    rows += len(grams)
            if rows > 3_000_000:
                held = {lang: [summed(parts)] for lang, parts in held.items()}
                rows = sum(len(parts[0][0]) for parts in held.values())
                if rows > 2_000_000:
                    yield from out(held)
                    held, rows = {}, 0
        yield from out({lang: [summed(parts)] for lang, parts in held.items()})

    def out(held):
        for lang, [(grams, n)] in held.items():
            for i in range(0, len(grams), 100_000):
                g = grams[i : i + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(g)), pa.array(g.view(np.int64)), pa.array(n[i : i + 100_000], pa.int64())],
                    names=["lang", "gram", "n"],
                )

    short_batches(docs.sparkSession)
    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(compute, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def slices(texts: list[str], most: int = 1 << 20):
    """Lists of (number, text) of about `most` characters; longer texts are cut beside words."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for piece in cut(text, most) if len(text) > most else (text,):
            if held and size + len(piece) > most:
                yield held
                held, size = [], 0
            held.append((i, piece))
            size += len(piece)
    if held:
        yield held


def cut(text: str, most: int):
    a = 0
    while a < len(text):
        b = min(a + most, len(text))
        if b < len(text):  # back to a space, unless there is none
            space = max(text.rfind(" ", a + 1, b), text.rfind("\n", a + 1, b))
            b = space if space > 0 else b
        yield text[a:b]
        a = b


def summed(parts):
    grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(where, np.concatenate([n for _, n in parts]), len(grams)).astype(np.int64)


@dataclass
class LanguageFilter:
    languages: list[str]
    slots: np.ndarray  # (slots, words of 64 languages)
    common: int  # the language with the most n-grams

    @classmethod
    def build(cls, languages: list[str], grams: np.ndarray, which: np.ndarray, common: int, bits_per_gram: int = 12):
        size = 1 << max(10, int(bits_per_gram * max(1, len(np.unique(grams))) - 1).bit_length())
        slots = np.zeros((size, max(1, -(-len(languages) // 64))), np.uint64)
        for position in cls.positions(grams, size):
            np.bitwise_or.at(slots, (position, which // 64), np.uint64(1) << (which % 64).astype(np.uint64))
        return cls(languages, slots, common)

    @staticmethod
    def positions(grams: np.ndarray, size: int):
        step = mixed(grams + np.uint64(77)) | np.uint64(1)
        for i in range(HASHES):
            yield ((grams + np.uint64(i) * step) & np.uint64(size - 1)).astype(np.int64)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        found = np.full((len(grams), self.slots.shape[1]), np.iinfo(np.uint64).max)
        for position in self.positions(grams, len(self.slots)):
            found &= self.slots[position]
        return found

    def false_rates(self) -> np.ndarray:
        fill = [
            ((self.slots[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(self.languages))
        ]
        return np.array(fill) ** HASHES

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score, the share of its corrected count in all languages' counts."""
        n, has = np.zeros(len(texts)), np.zeros(len(texts), bool)
        hits = np.zeros((len(texts), len(self.languages)))
        for some in slices(texts):
            number = np.array([i for i, _ in some])
            grams, owner, lettered = ngrams([t for _, t in some])
            has[number[lettered]] = True
            owner = number[owner]
            n += np.bincount(owner, minlength=len(texts))
            masks = self.masks(grams)
            for i in range(len(self.languages)):
                hit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                hits[:, i] += np.bincount(owner, hit, len(texts))
        wrong = self.false_rates()
        votes = np.maximum(0.0, (hits - n[:, None] * wrong) / (1 - wrong))
        out = []
        for row, lettered in zip(votes, has):
            total = row.sum()
            if not lettered or not self.languages:
                out.append((UNKNOWN, 0.0))
            elif not total:
                out.append((self.languages[self.common], 0.0))
            else:
                out.append((self.languages[int(row.argmax())], float(row.max() / total)))
        return out


def learn(docs: DataFrame) -> LanguageFilter:
    """Count the n-grams of all of `docs` (text, lang) with a language and make the filter.

    What reaches the driver and is broadcast holds at most len(SIZES) / RATE n-grams per language.
    """
    counts = stored(counted(docs.where("lang is not null")))
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageFilter([], np.zeros((1, 1), np.uint64), 0)
    rate = F.col("n") / F.create_map(*[F.lit(x) for lang in languages for x in (lang, float(max(1, totals[lang])))])[F.col("lang")]
    # n-grams below RATE everywhere cannot be held by any language
    rates = counts.select("lang", "gram", rate.alias("rate")).where(F.col("rate") >= RATE)
    best = rates.groupBy("gram").agg(F.max("rate").alias("best"))
    held = rates.join(best, "gram").where(F.col("rate") >= SHARE * F.col("best")).select("gram", "lang").toArrow()
    grams = held.column("gram").to_numpy().view(np.uint64)
    number = {lang: i for i, lang in enumerate(languages)}
    which = np.array([number[x] for x in held.column("lang").to_pylist()], np.int64)
    return LanguageFilter.build(languages, grams, which, number[max(languages, key=lambda x: totals[x])])


def identify(docs: DataFrame, held_out: tuple[int, int] = (3, 1)) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `docs` (doc_id, text, lang).

    Learns from the rows with a language whose crc32(doc_id) modulo
    `held_out[0]` is not `held_out[1]`. A null text and one without a letter are
    `und` with score 0; so is every text if there is nothing to learn from. Letters
    that no language knows give the most common language, score 0; ties go
    to the smaller name. A null doc_id stays null; repeated rows get a row
    each; an empty table gives no rows.
    """
    split = remainder(F.col("doc_id"), held_out[0])
    model = docs.sparkSession.sparkContext.broadcast(learn(docs.where(split != held_out[1])))

    def compute(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = model.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    short_batches(docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        compute, "doc_id long, lang_pred string, score double"
    )
    return scored.select("doc_id", (split == held_out[1]).alias("held_out"), "lang_pred", "score")
