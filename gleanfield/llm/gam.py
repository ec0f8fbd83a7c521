"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn on one binned feature after another, then
on the most useful pairs of features. A tree on one feature only adds to that feature's
table of bins, so the model is a set of lookup tables and a score is a sum of
table entries.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanfield.llm.common import remainder, short_batches, stored

# ASCII classes, fixed values
LETTERS = np.array([chr(i).isalpha() if i < 128 else False for i in range(256)])
UPPERS = np.array([65 <= i <= 90 for i in range(256)])
DIGITS = np.array([48 <= i <= 57 for i in range(256)])
SPACES = np.array([i == 32 or 9 <= i <= 13 for i in range(256)])
MARKS = np.array([i < 128 and not (chr(i).isalnum() or SPACES[i] or i < 32) for i in range(256)])

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "marks", "wide", "top_mark", "pipes",
    "marked_words", "unlettered_words", "distinct_words", "distinct_pairs", "repeats", "top_word",
    "line_words", "distinct_lines", "short_words", "long_words", "sentences", "controls",
]


def text_features(text: bytes) -> list[float]:
    """Numbers that describe a text; an empty one has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [float(np.log1p(len(text)))] + [0.0] * (len(FEATURES) - 1)
    size = len(text)
    byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lettered = int(byte[LETTERS].sum()) + int(byte[128:].sum()) or 1
    filled = size - int(byte[SPACES].sum())
    marks = byte[MARKS]
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    return [
        float(np.log1p(size)), float(np.log1p(n)), filled / n, int(byte[UPPERS].sum()) / lettered,
        int(byte[DIGITS].sum()) / filled, int(marks.sum()) / filled, int(byte[128:].sum()) / filled,
        int(marks.max()) / filled, int(byte[124]) / n, float(MARKS[ends].mean()),
        sum(not (w.isalpha() or any(c >= 128 or LETTERS[c] for c in w)) for w in seen) / len(seen),
        len(seen) / n ** 0.8, pairs / max(n - 1, 1), sum(map(bytes.__eq__, words, words[1:])) / n,
        max(seen.values()) / n, n / len(lines), len(set(lines)) / len(lines), float((lengths <= 2).mean()),
        float((lengths >= 14).mean()), int(byte[[33, 46, 63]].sum()) / n, int(byte[:9].sum() + byte[14:32].sum()) / size,
    ]


def with_features(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) as doc_id and the array `features`."""

    def compute(batches):
        for batch in batches:
            rows = [text_features(t or b"") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "features"])

    short_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        compute, "doc_id long, features array<double>"
    )


@dataclass
class Tables:
    """Bin borders per feature, a table of scores per feature, and a grid per pair."""

    borders: list[np.ndarray]
    single: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, x[:, j], side="right") for j, b in enumerate(self.borders)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        at = self.bins(np.nan_to_num(x, posinf=0.0, neginf=0.0))
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.single):
            total += table[at[:, j]]
        for j, k, grid in self.pairs:
            total += grid[at[:, j], at[:, k]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def stump_steps(gradient: np.ndarray, weight: np.ndarray, leaves: int, penalty: float) -> np.ndarray:
    """Per bin the value of a tree on ordered bins, grown by its best splits to `leaves` leaves."""
    g, h = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    parts = [(0, len(gradient))]

    def gain(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + penalty)

    def best(a, b):
        cuts = np.arange(a + 1, b)
        if not len(cuts):
            return 0.0, a
        won = (g[cuts] - g[a]) ** 2 / (h[cuts] - h[a] + penalty) + (g[b] - g[cuts]) ** 2 / (h[b] - h[cuts] + penalty) - gain(a, b)
        return won.max(), int(cuts[won.argmax()])

    while len(parts) < leaves:
        (won, cut), i = max((best(*p), i) for i, p in enumerate(parts))
        if won <= 1e-12:
            break
        a, b = parts[i]
        parts[i : i + 1] = [(a, cut), (cut, b)]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + penalty)
    return out


def grid_steps(gradient: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Gain and values of a tree of depth two on two features: one cut of the first, one of the
    second on either side."""
    g, h = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    won, values = 0.0, np.zeros_like(gradient)
    for r in range(len(g) - 1):
        halves = [(g[r], h[r], slice(0, r + 1)), (g[-1] - g[r], h[-1] - h[r], slice(r + 1, None))]
        found = 0.0
        cells = []
        for gh, hh, rows in halves:
            split = gh**2 / (hh + penalty) + (gh[-1] - gh) ** 2 / (hh[-1] - hh + penalty)
            c = int(split.argmax())
            found += split[c]
            cells += [(rows, slice(0, c + 1), gh[c] / (hh[c] + penalty)), (rows, slice(c + 1, None), (gh[-1] - gh[c]) / (hh[-1] - hh[c] + penalty))]
        if found > won:
            won, values = found, np.zeros_like(gradient)
            for rows, columns, value in cells:
                values[rows, columns] = value
    return won - g[-1, -1] ** 2 / (h[-1, -1] + penalty), values


def fit(x: np.ndarray, y: np.ndarray, bins=48, rounds=120, pairs=8, pair_rounds=40, rate=0.15, leaves=4, penalty=1.0) -> Tables:
    """Learn the tables from features `x` and labels `y` (0 or 1); without both labels, the share of 1."""
    x = np.nan_to_num(x, posinf=0.0, neginf=0.0)
    n, width = x.shape if x.ndim == 2 and len(x) else (0, len(FEATURES))
    share = np.clip((y.sum() + 0.5) / (n + 1), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    cuts = np.linspace(0, 1, bins + 1)[1:-1]
    borders = [np.unique(np.quantile(x[:, j], cuts)) if n else np.empty(0) for j in range(width)]
    model = Tables(borders, [np.zeros(len(b) + 1) for b in borders], [], base)
    if not 0 < y.sum() < n:
        return model
    at = model.bins(x)
    total = np.full(n, base)

    def residual():
        p = 1 / (1 + np.exp(-total))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j in range(width):
            r, w = residual()
            size = len(model.single[j])
            step = rate * np.clip(stump_steps(np.bincount(at[:, j], r, size), np.bincount(at[:, j], w, size), leaves, penalty), -4, 4)
            model.single[j] += step
            total += step[at[:, j]]

    def grid(j, k, values):
        shape = len(model.single[j]), len(model.single[k])
        return np.bincount(at[:, j] * shape[1] + at[:, k], values, shape[0] * shape[1]).reshape(shape)

    r, w = residual()
    gains = sorted(((grid_steps(grid(j, k, r), grid(j, k, w), penalty)[0], j, k) for j in range(width) for k in range(j)), reverse=True)
    model.pairs = [(j, k, np.zeros((len(model.single[j]), len(model.single[k])))) for gain, j, k in gains[:pairs] if gain > 0]
    for _ in range(pair_rounds):
        for j, k, table in model.pairs:
            r, w = residual()
            step = rate * np.clip(grid_steps(grid(j, k, r), grid(j, k, w), penalty)[1], -4, 4)
            table += step
            total += step[at[:, j], at[:, k]]
    return model


def chosen(labels: DataFrame, sample_rows: int, held_out: tuple[int, int]) -> DataFrame:
    """doc_id and quality of at most `sample_rows` labels, taken in the order of a hash of the id.

    Ids whose crc32 modulo `held_out[0]` is `held_out[1]` are never taken, nor are labels other
    than 0 and 1 and null ids; an id labelled both ways counts as 1.
    """
    marks = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    )
    learned = marks.where(remainder(F.col("doc_id"), held_out[0]) != held_out[1])
    return stored(learned.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))


def learn(features: DataFrame, labels: DataFrame) -> Tables:
    """Fit on the rows of `features` that have one of the labels (`chosen`), one per id."""
    marked = features.join(F.broadcast(labels), "doc_id").groupBy("doc_id").agg(
        F.min("features").alias("features"), F.max("quality").alias("quality")
    )
    rows = marked.toArrow().sort_by("doc_id")
    x = np.array(rows.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, rows.column("quality").to_numpy().astype(float))


def apply_tables(features: DataFrame, model: Tables) -> DataFrame:
    """doc_id and score of rows of doc_id and features, by sums of table entries."""

    def compute(batches):
        for pdf in batches:
            x = np.stack(pdf["features"].to_list()) if len(pdf) else np.empty((0, len(FEATURES)))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": model.score(x)})

    return features.mapInPandas(compute, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = 30_000) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs` (doc_id, text).

    Only the text is looked at. A null text scores as an empty one; a null
    doc_id stays null; repeated rows get a row each; an empty table gives no
    rows. Without labels of both kinds every score is their share, or a half.
    """
    features = stored(with_features(docs))
    scored = apply_tables(features, learn(features, chosen(labels, sample_rows, (3, 1))))
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = 30_000) -> DataFrame:
    """Rows of `docs` whose text scores 0.5 or more, all columns as they were.

    Texts are scored where they lie, and those learned from are found by a broadcast of at most
    `sample_rows` ids: no row of `docs` is shuffled.
    """
    marks = chosen(labels, sample_rows, (3, 1))
    marked = docs.join(F.broadcast(marks.select("doc_id")), "doc_id", "left_semi")
    model = learn(stored(with_features(marked)), marks)
    score = F.pandas_udf(lambda texts: pd.Series(model.score(np.array([text_features(t or b"") for t in texts], float).reshape(-1, len(FEATURES)))), "double")
    short_batches(docs.sparkSession)
    return docs.where(score(F.col("text").cast("binary")) >= 0.5)
