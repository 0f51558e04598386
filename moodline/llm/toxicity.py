"""Toxicity by classifier chains.

Categories are predicted one after the other. Each has a logistic model over marker words, words
found to go with a category on the labelled rows, and over the probabilities of the categories
before it. In training these probabilities come from models that haven't seen the row (out-of-fold),
so that a later model trusts them as far as they deserve.

The models are fitted on at most ``sample`` labelled documents, those with the smallest hashes of
their ids; scoring covers every whole text. A null or empty text has no words and gets the base
probability; a text's score depends on nothing but its words, so ties and repeated rows score alike.
A label of null isn't used; of several labels of an id the largest counts. Without labels of both
kinds a category has its base rate, 0 without any, and nothing is rejected.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.session import stage

SAMPLE = 8192  # labelled documents that the models are fitted on, at most
MARKERS = 128  # words kept for each category, at most
MIN_DOCS, MIN_GAIN = 3, 10.8  # of a marker: documents, and twice the log-likelihood ratio
FOLDS = 4
RIDGE = 0.1

_LETTERS = re.compile(r"[^\W\d_]+")


def distinct_words(text: str | None) -> set[str]:
    return set(_LETTERS.findall(text.lower())) if text else set()


@dataclass(frozen=True)
class Chain:
    """categories in the order of the chain; weights: markers, earlier categories, constant."""

    categories: tuple[str, ...]
    markers: dict[str, int]
    weights: tuple[np.ndarray, ...]
    threshold: float  # of the last category asked for by ``reject``
    reject: str

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.categories)))
        for k, w in enumerate(self.weights):
            out[:, k] = _sigmoid(_with(x, out[:, :k]) @ w)
        return out

    def features(self, texts: Sequence[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.markers)))
        known = self.markers.keys()
        for row, text in enumerate(texts):
            for w in distinct_words(text) & known:
                x[row, self.markers[w]] = 1.0
        return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _with(x: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    return np.hstack((x, _logit(earlier), np.ones((len(x), 1))))


def _fitted(x: np.ndarray, y: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the constant."""
    used = ~np.isnan(y)
    x, y = x[used], y[used]
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[-1] = -30.0 if not len(y) or y.max() == 0 else 30.0
        return w
    shrink = np.full(len(w), RIDGE)
    shrink[-1] = 1e-6
    w[-1] = math.log(y.mean() / (1 - y.mean()))
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        grad = x.T @ (y - p) - shrink * w
        curve = (x * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(curve, grad)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return w


def _chain(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Weights of each category's model and all out-of-fold probabilities."""
    unseen = np.zeros(y.shape)
    weights = []
    for k in range(y.shape[1]):
        data = _with(x, unseen[:, :k])
        weights.append(_fitted(data, y[:, k]))
        for f in range(FOLDS):
            out = fold == f
            if out.any():
                unseen[out, k] = _sigmoid(data[out] @ _fitted(data[~out], y[~out, k]))
    return weights, unseen


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F1 on out-of-fold probabilities; the middle of equally good ones."""
    used = ~np.isnan(y)
    p, y = p[used], y[used]
    cuts = np.arange(0.1, 0.91, 0.02)
    if not len(y) or y.max() == 0:
        return 2.0
    f1 = np.array([2 * (y * (p >= c)).sum() / (y.sum() + (p >= c).sum()) for c in cuts])
    return float(np.median(cuts[f1 >= f1.max() - 1e-12]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    reject: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> Chain:
    """A chain over ``categories`` (name: 0/1 column of ``labels``), in their order."""
    names = tuple(categories)
    marks = [c.cast("double").alias(f"y{k}") for k, c in enumerate(categories.values())]
    chosen = (
        labels.select(F.col(f"`{id_col}`").alias("id"), *marks)
        .filter("id is not null")
        .groupBy("id")
        .agg(*[F.max(f"y{k}").alias(f"y{k}") for k in range(len(names))])
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = stage(texts.join(F.broadcast(chosen), "id"), "toxicity-sample")  # chosen is at most ``sample`` rows

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of each word: documents, and for each category those with a label and the marked ones."""
        for frame in frames:
            seen: dict[tuple, Counter] = {}
            for text, *y in frame[["text", *[f"y{k}" for k in range(len(names))]]].itertuples(index=False):
                kind = tuple(None if v != v else int(v) for v in y)
                seen.setdefault(kind, Counter()).update(distinct_words(text))
                seen[kind][""] += 1  # all documents of this kind
            out = [(w, n, *[v if v is not None else -1 for v in kind]) for kind, c in seen.items() for w, n in c.items()]
            yield pd.DataFrame(out, columns=["word", "n", *[f"y{k}" for k in range(len(names))]])

    kinds = ", ".join(f"y{k} int" for k in range(len(names)))
    counts = stage(
        rows.mapInPandas(counted, f"word string, n long, {kinds}")
        .groupBy("word")
        .agg(
            F.sum("n").alias("n"),
            *[F.sum(F.when(F.col(f"y{k}") >= 0, F.col("n")).otherwise(0)).alias(f"of{k}") for k in range(len(names))],
            *[F.sum(F.when(F.col(f"y{k}") == 1, F.col("n")).otherwise(0)).alias(f"in{k}") for k in range(len(names))],
        ),
        "toxicity-words",
    )
    total = counts.filter("word = ''").first()
    markers: dict[str, int] = {}
    for k in range(len(names)):
        if total is None or not 0 < total[f"in{k}"] < total[f"of{k}"]:
            continue
        rate = F.lit(total[f"in{k}"] / total[f"of{k}"])
        n, hit = F.col(f"of{k}"), F.col(f"in{k}")
        gain = 2 * (
            F.when(hit > 0, hit * F.log(hit / (n * rate))).otherwise(0.0)
            + F.when(n > hit, (n - hit) * F.log((n - hit) / (n * (1 - rate)))).otherwise(0.0)
        )
        best = counts.filter((F.col("word") != "") & (n >= MIN_DOCS)).withColumn("gain", gain)
        for r in best.filter(F.col("gain") > MIN_GAIN).orderBy(F.desc("gain"), "word").limit(MARKERS).collect():
            markers.setdefault(r["word"], len(markers))

    blank = Chain(names, markers, (), 2.0, reject)

    def marked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [sorted(markers[w] for w in distinct_words(t) & markers.keys()) for t in frame["text"]]
            yield frame.drop(columns="text").assign(found=found)

    kinds = ", ".join(f"y{k} double" for k in range(len(names)))
    data = rows.withColumn("id", F.col("id").cast("string")).mapInPandas(marked, f"id string, {kinds}, found array<int>").toPandas()
    data = data.sort_values("id").reset_index(drop=True)  # at most ``sample`` rows of marker numbers
    x = np.zeros((len(data), len(markers)))
    for row, found in enumerate(data["found"]):
        x[row, list(found)] = 1.0
    y = data[[f"y{k}" for k in range(len(names))]].to_numpy(float)
    weights, unseen = _chain(x, y, np.arange(len(data)) % FOLDS)
    at = names.index(reject)
    return Chain(blank.categories, markers, tuple(weights), _threshold(unseen[:, at], y[:, at]), reject)


def probabilities(chain: Chain, text: Column) -> Column:
    """A struct with the probability of each category."""
    schema = ", ".join(f"`{c}` double" for c in chain.categories)

    @F.pandas_udf(schema)
    def score(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(chain.probabilities(chain.features(list(texts))), columns=list(chain.categories))

    return score(text)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a probability for each category (p_...), and whether the document is rejected."""
    p = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        probabilities(chain, F.col(f"`{text_col}`").cast("string")).alias("p"),
    )
    return p.select(
        "doc_id",
        *[F.col(f"p.{c}").alias(f"p_{c}") for c in chain.categories],
        (F.col(f"p.{chain.reject}") >= chain.threshold).alias("toxic"),
    )


def keep_clean(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """The rows that aren't rejected, with all their columns."""
    p = probabilities(chain, F.col(f"`{text_col}`").cast("string"))
    return docs.filter(p[chain.reject] < chain.threshold)


def label_categories(labels: DataFrame) -> dict[str, Column]:
    """The chain for a table with ``quality`` and ``toxic``: junk, toxic, and toxic prose.

    The table marks no finer categories, so these three are what its two marks make.
    """
    junk, toxic = labels["quality"] == 0, labels["toxic"] == 1
    return {"junk": junk.cast("int"), "toxic": toxic.cast("int"), "toxic_prose": (toxic & ~junk).cast("int")}
