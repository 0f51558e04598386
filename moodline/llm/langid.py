"""Language identification by string kernels.

Two texts are compared by the character n-grams that occur in both: a blended-spectrum presence
kernel, normalised by the numbers of their n-grams, over n = 1 to 4. The kernel's feature space is
approximated from landmark texts (Nystroem), and one-versus-rest kernel ridge regression gives a
score for each language. Since the kernel is an inner product of presence vectors, landmarks and
coefficients multiply out to one matrix, and a batch of texts is scored by one matrix product.

Landmarks and training rows are bounded samples of the labelled rows, by the hash of their ids. Only
letters count: a text that is null or has none is ``und`` with score 0. Case is folded. Texts of
equal letters score alike; ties go to the language that comes first by code point. Without labelled
rows every text is ``und``. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINING = 4096  # labelled texts, at most
LANDMARKS = 384
BUCKETS = 1 << 14  # of hashed n-grams
ORDERS = (1, 2, 3, 4)
RIDGE = 1e-2
SHARPNESS = 6.0  # of the score: margins to probabilities
GROUP = 64  # texts of one matrix product

UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")


def letters_of(text: str | None) -> str:
    """Lower-case words of letters with a space around each; empty without letters."""
    if not text:
        return ""
    kept = _OTHER.sub(" ", text.lower()).strip()
    return f" {kept} " if any(map(str.isalpha, kept)) else ""


def grams(text: str, seen: np.ndarray) -> None:
    """Marks the buckets of a text's n-grams in a row of booleans."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    h = np.zeros(len(code), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        size = len(code) - n + 1
        if size <= 0:
            break
        h = (h[:size] ^ code[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if n in ORDERS:
            place = (h + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)
            seen[place % np.uint64(len(seen))] = True


def occurring(texts: Sequence[str]) -> np.ndarray:
    """A row for each text: which n-gram buckets occur."""
    seen = np.zeros((len(texts), BUCKETS), bool)
    for row, text in enumerate(texts):
        grams(text, seen[row])
    return seen


def unit(seen: np.ndarray) -> np.ndarray:
    """Presence vectors of unit length."""
    out = seen.astype(np.float32)
    return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))


@dataclass(frozen=True)
class Classifier:
    languages: tuple[str, ...]
    weights: np.ndarray  # buckets x languages
    constants: np.ndarray

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        letters = [letters_of(t) for t in texts]
        names, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, best
        known = [i for i, t in enumerate(letters) if t]
        for at in range(0, len(known), GROUP):
            rows = known[at : at + GROUP]
            margins = unit(occurring([letters[i] for i in rows])) @ self.weights + self.constants
            odds = np.exp(SHARPNESS * (margins - margins.max(axis=1, keepdims=True)))
            odds /= odds.sum(axis=1, keepdims=True)
            for i, k, p in zip(rows, margins.argmax(axis=1).tolist(), odds.max(axis=1).tolist(), strict=True):
                names[i], best[i] = self.languages[k], p
        return names, best


def fit(
    docs: DataFrame,
    learn: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    training: int = TRAINING,
    landmarks: int = LANDMARKS,
) -> Classifier:
    """From the rows of ``docs`` where ``learn`` holds and the language isn't null."""
    rows = docs.filter(learn & F.col(f"`{lang_col}`").isNotNull()).select(
        F.xxhash64(F.col(f"`{id_col}`")).alias("place"),
        F.col(f"`{id_col}`").cast("string").alias("id"),
    )
    # ids first, then only their texts
    chosen = rows.orderBy("place", "id").limit(training).select("id").distinct()
    labelled = docs.filter(learn & F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("string").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    )

    def marked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            letters = [letters_of(t) for t in frame["text"]]
            bits = np.packbits(occurring(letters), axis=1)
            used = np.array([bool(t) for t in letters], bool)
            yield frame.assign(bits=[b.tobytes() for b in bits])[["id", "lang", "bits"]][used]

    # at most ``training`` rows of 2 kB come to the driver, however long the texts are
    sample = (
        labelled.join(F.broadcast(chosen), "id")  # at most ``training`` ids
        .mapInPandas(marked, "id string, lang string, bits binary")
        .orderBy("id", "lang", "bits")
        .limit(training)
        .toPandas()
    )
    y = sample["lang"].to_numpy()
    languages = tuple(sorted(set(y)))
    if not languages:
        return Classifier((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    packed = np.stack([np.frombuffer(b, np.uint8) for b in sample["bits"]])

    def vectors(rows) -> np.ndarray:
        return unit(np.unpackbits(packed[rows], axis=1).astype(bool))

    mark = vectors(_spread(y, landmarks))
    values, axes = np.linalg.eigh((mark @ mark.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    to_space = axes[:, good] / np.sqrt(values[good])  # kernel row -> Nystroem features
    gram = np.zeros((good.sum() + 1, good.sum() + 1))
    target = np.zeros((good.sum() + 1, len(languages)))
    share = {lang: 1 / (y == lang).sum() for lang in languages}  # languages weigh the same
    for at in range(0, len(y), 256):
        z = (vectors(slice(at, at + 256)) @ mark.T) @ to_space
        z = np.hstack((z, np.ones((len(z), 1))))
        own = y[at : at + 256]
        w = np.array([share[v] for v in own])[:, None]
        gram += (z * w).T @ z
        target += (z * w).T @ np.where(own[:, None] == np.array(languages), 1.0, -1.0)
    alpha = np.linalg.solve(gram + RIDGE * np.eye(len(gram)), target)
    return Classifier(languages, (mark.T @ (to_space @ alpha[:-1])).astype(np.float32), alpha[-1])


def _spread(languages: np.ndarray, landmarks: int) -> np.ndarray:
    """Rows of landmarks: of each language as many as its share asks for, one at least."""
    out = []
    for lang in sorted(set(languages)):
        own = np.flatnonzero(languages == lang)
        out.append(own[: max(1, round(landmarks * len(own) / len(languages)))])
    return np.concatenate(out)


def predict(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score."""

    @F.pandas_udf("lang_pred string, score double")
    def score(texts: pd.Series) -> pd.DataFrame:
        names, best = model.predict(list(texts))
        return pd.DataFrame({"lang_pred": names, "score": best})

    found = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), score(F.col(f"`{text_col}`").cast("string")).alias("p")
    )
    return found.select("doc_id", "p.lang_pred", "p.score")
