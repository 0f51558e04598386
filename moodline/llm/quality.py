"""Quality of documents: random Fourier features, ridge regression, isotonic calibration.

Each text becomes a row of statistics (``STATISTICS``). Random Fourier features (Rahimi & Recht 2007)
of the standardised statistics approximate a Gaussian kernel, so ridge regression on them is kernel
regression. It is fitted by its normal equations: every task sums the products of its rows, and the
sums of the tasks are added up in Spark, so all labelled rows count and the driver gets matrices of a
size that the number of features sets. The sums are kept by fold. Leaving a fold out of them gives
its rows scores of a model that has not seen them; an isotonic regression of the labels on these
scores turns a score into a probability.

Texts are read once, whole, into a stored table of statistics; all else works on that.

A null or empty text has no characters, all its statistics are 0, and it is scored like any other.
Texts of equal statistics score alike. Labels are 0 or 1; other labels and null ones don't count, an
id with several labels has their mean, and every row of an id with a label is learned from. A null id
has no label. With no labelled row every score is 0.5. An empty table gives an empty result. Columns
of other names are not looked at. A very long text costs time in proportion to its length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodline.session import stage

FEATURES = 256  # of the Fourier map
FOLDS = 4
RIDGE = 1e-3  # per labelled row
SPREAD = 4.0  # statistics further from the mean, in deviations, count as so far
BINS = 1024  # of a unit of the score, for the calibration
SEED = 20240229

#: Byte classes by value: letter, upper-case letter, vowel, digit, sentence mark, symbol, white space.
LETTER, UPPER, VOWEL, DIGIT, MARK, SYMBOL, SPACE = (1 << k for k in range(7))


def _byte_classes() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 128 or c.isalpha():
            out[b] |= LETTER
        if b < 128 and c.isupper():
            out[b] |= UPPER
        if b < 128 and c.lower() in "aeiouy":
            out[b] |= VOWEL
        if b < 128 and c.isdigit():
            out[b] |= DIGIT
        if c in ".,;:!?'\"()-":
            out[b] |= MARK
        elif b < 128 and not c.isalnum() and not c.isspace() and b > 32:
            out[b] |= SYMBOL
        if c in " \t\n\v\f\r":
            out[b] |= SPACE
    return out


_CLASS = _byte_classes()
_LETTERED = re.compile(rb"[A-Za-z\x80-\xff]").search

STATISTICS = (
    "log_chars", "log_words", "word_length", "word_length_deviation", "distinct_words", "top_word",
    "top_words", "once_words", "distinct_pairs", "repeated_neighbours", "letters", "upper", "vowels",
    "digits", "marks", "symbols", "spaces", "exclamations", "byte_entropy", "log_lines", "line_length",
    "distinct_lines", "line_ends", "short_words", "long_words", "wordless", "capitalised", "ended_words",
)


def statistics(text: bytes) -> np.ndarray:
    """The statistics of one text (UTF-8)."""
    out = np.zeros(len(STATISTICS))
    if not text:
        return out
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)

    def share(kind: int, of: int) -> float:
        return float(count[(_CLASS & kind) > 0].sum()) / max(of, 1)

    n = len(text)
    letters = int(count[(_CLASS & LETTER) > 0].sum())
    p = count[count > 0] / n
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    w = len(words)
    out[[0, 1]] = np.log1p(n), np.log1p(w)
    if w:
        seen = Counter(words)
        top = seen.most_common(5)
        sizes = np.fromiter(map(len, words), np.int64, w)
        out[2:9] = (
            sizes.mean(), sizes.std(), len(seen) / w, top[0][1] / w, sum(c for _, c in top) / w,
            sum(c == 1 for c in seen.values()) / w, len(set(zip(words, words[1:], strict=False))) / max(w - 1, 1),
        )
        out[9] = sum(map(bytes.__eq__, words, words[1:])) / w
        out[23], out[24] = (sizes <= 3).mean(), (sizes >= 12).mean()
        out[25] = sum(c for x, c in seen.items() if not _LETTERED(x)) / w
        out[26] = sum(c for x, c in seen.items() if 65 <= x[0] <= 90 and not x.isupper()) / w
        out[27] = sum(c for x, c in seen.items() if x[-1:] in b".,;:!?") / w
    out[10:18] = (
        letters / n, share(UPPER, letters), share(VOWEL, letters), share(DIGIT, n), share(MARK, n),
        share(SYMBOL, n), share(SPACE, n), count[33] / n,
    )
    out[18] = float(-(p * np.log2(p)).sum())
    if lines:
        out[19], out[20] = np.log1p(len(lines)), np.log1p(n / len(lines))
        out[21] = len(set(lines)) / len(lines)
        out[22] = sum(line.rstrip()[-1:] in b".!?" for line in lines) / len(lines)
    return out


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of each row's whole text."""
    chosen = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b"")).alias("text"),
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])

    schema = T.StructType([chosen.schema["doc_id"]]).add("x", T.ArrayType(T.DoubleType()))
    return chosen.mapInArrow(measure, schema)


@dataclass(frozen=True)
class FourierMap:
    """Standardised rows -> cosine features whose inner products approximate a Gaussian kernel."""

    mean: np.ndarray
    deviation: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def drawn(cls, mean: np.ndarray, deviation: np.ndarray, features: int = FEATURES, width: float | None = None, seed: int = SEED):
        """``width`` of the kernel in deviations; the root of the number of statistics by default."""
        draw = np.random.default_rng(seed)
        d = len(mean)
        directions = draw.standard_normal((d, features)) / (width or np.sqrt(d))
        flat = np.where(deviation > 1e-9, deviation, np.inf)  # a constant statistic says nothing
        return cls(mean, flat, directions, draw.uniform(0, 2 * np.pi, features))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Features and a constant 1."""
        z = np.clip((x - self.mean) / self.deviation, -SPREAD, SPREAD)
        f = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack((f, np.ones((len(x), 1))))


def solve(gram: np.ndarray, moment: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Ridge weights from the normal equations; the constant, last, is not penalised."""
    penalty = np.full(len(gram), ridge * max(gram[-1, -1], 1.0))
    penalty[-1] = 1e-9
    return np.linalg.solve(gram + np.diag(penalty), moment)


def isotonic(place: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: blocks' mean places and their rising means."""
    blocks: list[list[float]] = []  # weight, sum of places, sum of labels
    for p, m, w in zip(place, mean, weight, strict=True):
        blocks.append([w, w * p, w * m])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    w, p, m = np.array(blocks).T
    return p / w, m / w


@dataclass(frozen=True)
class Model:
    fourier: FourierMap | None
    weights: np.ndarray
    places: np.ndarray  # of the calibration, rising
    levels: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.fourier(x) @ self.weights, self.places, self.levels), 0.0, 1.0)


def _frame(frame: pd.DataFrame) -> np.ndarray:
    return np.array(frame["x"].tolist(), float).reshape(len(frame), len(STATISTICS))


def sums_by_fold(learned: DataFrame, fourier: FourierMap, folds: int) -> dict[int, np.ndarray]:
    """Fold -> sums of z z' and z y, side by side, over (fold, x, y) rows.

    A task sends one row of sums for each fold and feature; Spark adds them up, partly before the
    shuffle. ``folds`` matrices come to the driver.
    """
    width = len(fourier.phases) + 1

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((folds, width, width + 1))
        met = set()
        for frame in frames:
            z = fourier(_frame(frame))
            zy = np.hstack((z, frame["y"].to_numpy(float)[:, None]))
            for k in frame["fold"].unique():
                own = (frame["fold"] == k).to_numpy()
                sums[k] += z[own].T @ zy[own]
                met.add(int(k))
        for k in sorted(met):
            yield pd.DataFrame({"fold": k, "feature": range(width), "sums": list(sums[k])})

    rows = (
        learned.mapInPandas(partial, "fold int, feature int, sums array<double>")
        .groupBy("fold", "feature")
        .agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
        .collect()
    )
    out = {k: np.zeros((width, width + 1)) for k in range(folds)}
    for row in rows:
        out[row["fold"]][row["feature"]] = row["sums"]
    return out


def labelled(rows: DataFrame, labels: DataFrame, learn: Column, id_col: str, label_col: str, folds: int) -> DataFrame:
    """(fold, x, y) of the rows in ``rows`` (doc_id, x) to learn from."""
    marks = (
        labels.filter(F.col(f"`{label_col}`").isin(0, 1))
        .groupBy(F.col(f"`{id_col}`").alias("doc_id"))
        .agg(F.avg(F.col(f"`{label_col}`").cast("double")).alias("y"))
    )
    fold = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(folds)).cast("int")
    return rows.filter(learn).join(marks, "doc_id").select(fold.alias("fold"), "x", "y")


def fit(
    rows: DataFrame,
    labels: DataFrame,
    learn: Column,
    label_col: str = "quality",
    id_col: str = "doc_id",
    features: int = FEATURES,
    folds: int = FOLDS,
    ridge: float = RIDGE,
) -> Model:
    """From ``measured`` rows where ``learn``, a condition on doc_id, holds and ``labels`` has a 0 or 1."""
    learned = stage(labelled(rows, labels, learn, id_col, label_col, folds), "quality-learned")
    places = range(len(STATISTICS))
    row = learned.agg(
        F.count(F.lit(1)),
        *[F.avg(F.get("x", F.lit(k))) for k in places],
        *[F.stddev_pop(F.get("x", F.lit(k))) for k in places],
    ).first()
    if not row[0]:
        return Model(None, np.zeros(0), np.zeros(0), np.zeros(0))
    d = len(STATISTICS)
    fourier = FourierMap.drawn(np.array(row[1 : d + 1]), np.array(row[d + 1 :]), features)
    sums = sums_by_fold(learned, fourier, folds)
    total = sum(sums.values())

    def weights(s: np.ndarray) -> np.ndarray:
        return solve(s[:, :-1], s[:, -1], ridge)

    unseen = np.stack([weights(total - sums[k]) for k in range(folds)])

    @F.pandas_udf("double")
    def out_of_fold(fold: pd.Series, x: pd.Series) -> pd.Series:
        z = fourier(np.array(x.tolist(), float).reshape(len(x), d))
        return pd.Series((z * unseen[fold.to_numpy()]).sum(axis=1))

    # scores of labels 0 and 1: those beyond -1 and 2 share the outermost bins
    score = F.least(F.greatest(out_of_fold("fold", "x"), F.lit(-1.0)), F.lit(2.0))
    binned = (
        learned.select(F.floor(score * BINS).alias("bin"), "y")
        .groupBy("bin")
        .agg(F.avg("y").alias("mean"), F.count("y").alias("n"))
        .orderBy("bin")
        .toPandas()  # 3 * BINS + 1 rows at most
    )
    at, level = isotonic((binned["bin"].to_numpy() + 0.5) / BINS, binned["mean"].to_numpy(), binned["n"].to_numpy(float))
    return Model(fourier, weights(total), at, level)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of ``measured`` rows."""

    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist(), float).reshape(len(x), len(STATISTICS))))

    return rows.select("doc_id", scored("x").alias("score"))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.3,
) -> DataFrame:
    """doc_id, score, predicted of every row; ``learn`` is a condition on ``doc_id``."""
    rows = stage(measured(docs, id_col, text_col), "quality-statistics")
    model = fit(rows, labels, learn, label_col, id_col)
    return score(rows, model).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
