"""Labels, indicators and small numeric measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodline.functions.columns import as_column

# Label words, their indicators, class order of the aspect scorer.
POSITIVE, NEUTRAL, NEGATIVE = "positive", "neutral", "negative"
INDICATORS = {NEUTRAL: 0, POSITIVE: 1, NEGATIVE: -1}
CLASS_LABELS = (NEGATIVE, NEUTRAL, POSITIVE)
DEFAULT_THRESHOLD = 0.05


def nan_to_null(value: Column | str) -> Column:
    """NaN sorts above every number in Spark; as null it compares as unknown."""
    value = as_column(value)
    return F.when(~F.isnan(value), value)


def threshold_label(score: Column | str, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """positive at or above the threshold, negative at or below its mirror, else neutral."""
    score = nan_to_null(as_column(score).cast("double"))
    return (
        F.when(score >= threshold, POSITIVE).when(score <= -threshold, NEGATIVE).otherwise(NEUTRAL)
    )


def label_indicator(label: Column | str) -> Column:
    """1, 0 or -1 for a label in any letter case; unknown labels give null."""
    label = F.lower(as_column(label))
    out = None
    for word, value in INDICATORS.items():
        out = F.when(label == word, value) if out is None else out.when(label == word, value)
    return out.cast("int")


def entity_indicator(candidate: Column | str, entity: str) -> Column:
    """1 on rows about the entity, else 0, also for unknown candidates."""
    return F.when(as_column(candidate) == entity, 1).otherwise(0)


def ratio_of(total: Column, count: Column) -> Column:
    """total / count, null for an empty group."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def softsign(value: Column | str) -> Column:
    value = as_column(value)
    return value / (F.abs(value) + 1)


def complement(probability: Column | str) -> Column:
    return F.lit(1.0) - as_column(probability)


def binarise(value: Column | str, cut: float = 0.5) -> Column:
    """1 above the cut, else 0."""
    return F.when(nan_to_null(as_column(value)) > cut, 1).otherwise(0)


def softmax(logits: Column | str) -> Column:
    """Class probabilities; shifted by the largest logit so that exp cannot overflow."""
    logits = as_column(logits)
    powers = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(
        powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda acc, q: acc + q)
    )


def top_label(scores: Column | str, labels: Sequence[str] = CLASS_LABELS) -> Column:
    """Label of the largest score, the first one on a tie."""
    scores = as_column(scores)
    position = F.array_position(scores, F.array_max(scores)).cast("int")
    names = F.array(*[F.lit(name) for name in labels])
    return F.when(position > 0, F.element_at(names, position))
