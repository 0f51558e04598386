"""A linear aspect model: class scores of a mention from the words around it.

Features of a mention are hashed: the tokens of a window on either side, once by themselves and once
with their side and distance. Tokens are words and runs of punctuation marks; that a word is in
capitals is a feature of its own. Multinomial logistic regression is fitted on all labelled mentions by
Spark ML: a pass over the stored features per step, summed in the executors, so the driver holds
the coefficients and no rows. The fitted model is an aspect scorer like any other (``scoring.label_aspects``).
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import SparkContext, cloudpickle
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodline.functions.measures import CLASS_LABELS
from moodline.schemas import mention
from moodline.session import stage_path

# Code of this module travels to the Python workers with the job, so they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 8  # tokens on either side of a mention
BUCKETS = 1 << 14  # of hashed features
NEAR = 3  # distances told apart
L2 = 1e-4
STEPS = 60

_TOKEN = re.compile(r"\w+|[^\w\s]+")


def places_of(tokens: Sequence[str], aspect: Sequence[str]) -> list[int]:
    """Where the words of an aspect start; an aspect may have several."""
    n = len(aspect)
    first = aspect[0]
    return [i for i, t in enumerate(tokens) if t == first and list(tokens[i : i + n]) == list(aspect)]


def window_features(text: str, aspect: str, width: int = WIDTH, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets, rising, and values (of unit length together) of the mentions of an aspect in a text.

    A text without the aspect as a whole word counts as one window. No tokens give no features.
    """
    written = _TOKEN.findall(text)
    tokens = [t.lower() for t in written]
    named = _TOKEN.findall(aspect.lower())
    places = places_of(tokens, named) if named else []
    spans = [(p - width, p, p + len(named), p + len(named) + width) for p in places] or [(0, 0, 0, len(tokens))]
    counts: dict[int, float] = {}

    def add(feature: str) -> None:
        h = zlib.crc32(feature.encode("utf-8", "surrogatepass"))
        bucket = h % buckets
        counts[bucket] = counts.get(bucket, 0.0) + (1.0 if h >> 31 else -1.0)

    for start, before, after, end in spans:
        for i in [*range(max(start, 0), before), *range(after, min(end, len(tokens)))]:
            far = min(before - i if i < before else i - after + 1, NEAR)
            add(tokens[i])
            add(f"{'<' if i < before else '>'}{far} {tokens[i]}")
            if len(written[i]) > 1 and written[i].isupper():
                add("^")
    found = sorted((b, v) for b, v in counts.items() if v)
    index = np.array([b for b, _ in found], np.int64)
    value = np.array([v for _, v in found], np.float64)
    size = np.sqrt((value**2).sum())
    return index, value / size if size else value


class AspectModel:
    """Coefficients of the classes, in the order of ``CLASS_LABELS``; sent to a worker once."""

    def __init__(self, context: SparkContext, weights: np.ndarray, constants: np.ndarray, width: int):
        self.sent = context.broadcast((weights, constants))
        self.width = width
        self.loss: list[float] = []

    @cached_property
    def _loaded(self) -> tuple[np.ndarray, np.ndarray]:
        return self.sent.value

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_loaded"}

    def __call__(self, texts: Sequence[str], aspect: str) -> list[list[float]]:
        weights, constants = self._loaded
        out = []
        for text in texts:
            index, value = window_features(text, aspect, self.width, weights.shape[1])
            out.append((weights[:, index] @ value + constants).tolist())
        return out


def mention_rows(
    df: DataFrame, entities: Sequence[str], label: Column, text: str, width: int = WIDTH, buckets: int = BUCKETS
) -> DataFrame:
    """(label, features): a row per labelled mention; ``label`` is the number of a class, null is none.

    Stored, features as the parts of a sparse vector, and read back as the vectors they are.
    """
    pairs = F.array(*[F.struct(F.lit(e).alias("aspect"), (F.col(mention(e)) == 1).alias("there")) for e in entities])
    rows = (
        df.select(label.cast("double").alias("label"), F.col(text).alias("text"), F.inline(pairs))
        .filter("there and label is not null and text is not null")
        .select("label", "text", "aspect")
    )

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [window_features(t, a, width, buckets) for t, a in zip(frame["text"], frame["aspect"], strict=True)]
            parts = {"indices": [i for i, _ in found], "values": [v for _, v in found]}
            yield pd.DataFrame({"label": frame["label"].to_numpy(), **parts})

    parts = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(buckets).alias("size"), "indices", "values"  # 0: sparse
    )
    path = stage_path(df.sparkSession, "aspect-mentions")
    rows = rows.mapInPandas(features, "label double, indices array<int>, values array<double>")
    rows.select("label", parts.alias("features")).write.parquet(path)
    schema = T.StructType().add("label", "double").add("features", VectorUDT())
    return df.sparkSession.read.schema(schema).parquet(path)


def train_aspect_model(
    df: DataFrame,
    entities: Sequence[str],
    label: Column,
    *,
    text: str = "textdata",
    width: int = WIDTH,
    buckets: int = BUCKETS,
    l2: float = L2,
    steps: int = STEPS,
) -> AspectModel:
    """Fit on every mention whose ``label`` (number of a class) isn't null.

    A class that no row has gets scores below those of all others. No labelled mention at all is
    an error.
    """
    rows = mention_rows(df, entities, label, text, width, buckets)
    if rows.isEmpty():
        raise ValueError("no labelled mention to learn from")
    fitted = LogisticRegression(
        family="multinomial", regParam=l2, standardization=False, maxIter=steps, tol=1e-8
    ).fit(rows)
    weights = np.zeros((len(CLASS_LABELS), buckets))
    constants = np.full(len(CLASS_LABELS), -1e9)
    found = fitted.coefficientMatrix.toArray()
    weights[: len(found)] = found
    # Spark gives a class below the greatest that has no row a constant of minus infinity
    constants[: len(found)] = np.maximum(fitted.interceptVector.toArray(), -1e9)
    model = AspectModel(df.sparkSession.sparkContext, weights, constants, width)
    model.loss = list(fitted.summary.objectiveHistory)
    return model
