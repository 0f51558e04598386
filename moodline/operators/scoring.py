"""Sentiment per mentioned entity: gated lexicon scores, and batched aspect scorers."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.measures import (
    DEFAULT_THRESHOLD,
    softmax,
    threshold_label,
    top_label,
)
from moodline.functions.text import PROMPT
from moodline.operators.lexicon import ROW, Scorer, attach_scores, score_in_place
from moodline.schemas import label_of, mention, score_of
from moodline.session import stage

# Code of this module travels to the Python workers with the job, so they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# (texts, aspect) -> one sequence of logits per text, in the class order of CLASS_LABELS
AspectScorer = Callable[[Sequence[str], str], Sequence[Sequence[float]]]


def mentions_any(entities: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(mention(e)) == 1 for e in entities])


def score_mentions(
    df: DataFrame,
    scorer: Scorer,
    entities: Sequence[str],
    *,
    text: str = "textdata",
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Score and label per entity; rows that do not mention it get 0 and neutral.

    Each text is scored once, however many entities it mentions, and not at all if
    it mentions none. With a small word table that happens in place, without a shuffle. With a
    large one rows are told apart by a number of their own, so keys may repeat or be null: the
    table is stored once, which also spares what made it a second run. The text column is gone
    from the result.
    """
    once = score_in_place(scorer, F.when(mentions_any(entities), F.col(text)))
    if once is not None:
        scored = df.withColumn("_score_once", once).drop(text)
    else:
        rows = stage(df.withColumn(ROW, F.monotonically_increasing_id()), "mentions")
        texts = rows.filter(mentions_any(entities)).select(ROW, text)
        scored = attach_scores(rows.drop(text), scorer(texts, ROW, text), ROW, "_score_once").drop(ROW)
    gated = {
        score_of(e): F.when(F.col(mention(e)) == 1, F.col("_score_once")).otherwise(F.lit(0.0))
        for e in entities
    }
    labels = {label_of(e): threshold_label(score_of(e), threshold) for e in entities}
    return scored.withColumns(gated).withColumns(labels).drop("_score_once")


def _logits(scorer: AspectScorer, entities: Sequence[str], batch_size: int, prompt: bool):
    """UDF (text, flag per entity) -> one array of logits per entity, null without mention."""
    fields = ", ".join(f"`{e}` array<double>" for e in entities)

    @F.pandas_udf(f"struct<{fields}>")
    def logits(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, *flags in batches:
            out = {}
            for entity, flag in zip(entities, flags, strict=True):
                out[entity] = [None] * len(texts)
                places = ((flag == 1) & texts.notna()).to_numpy().nonzero()[0]
                for start in range(0, len(places), batch_size):
                    batch = places[start : start + batch_size]
                    given = texts.iloc[batch].tolist()
                    if prompt:
                        given = [PROMPT % (text, entity) for text in given]
                    for place, values in zip(batch, scorer(given, entity), strict=True):
                        out[entity][place] = [float(v) for v in values]
            yield pd.DataFrame({e: pd.Series(v, dtype="object") for e, v in out.items()})

    return logits


def label_aspects(
    df: DataFrame,
    scorer: AspectScorer,
    entities: Sequence[str],
    *,
    text: str = "textdata",
    batch_size: int = 32,
    prompt: bool = False,
) -> DataFrame:
    """Label per mentioned entity from a batched scorer; null where it is not mentioned.

    The scorer sees only texts that mention the entity, ``batch_size`` at a time, as
    they are or in the prompt layout. Each text goes to Python once, whatever the
    number of entities. Labels stay on their rows, so nothing is shuffled or joined.
    The text column is gone from the result.
    """
    shown = F.when(mentions_any(entities), F.col(text))
    logits = _logits(scorer, entities, batch_size, prompt)
    scored = df.withColumn("_logits", logits(shown, *[F.col(mention(e)) for e in entities]))
    labels = {label_of(e): top_label(softmax(f"_logits.`{e}`")) for e in entities}
    return scored.drop(text).withColumns(labels).drop("_logits")


class LexiconAspectScorer:
    """Aspect scorer without a trained model: mean valence of the known words.

    The middle logit is the threshold, so a mean nearer to 0 is neutral.
    """

    def __init__(self, valences: Mapping[str, float], threshold: float = DEFAULT_THRESHOLD):
        self.valences, self.threshold = dict(valences), threshold

    def __call__(self, texts: Sequence[str], aspect: str) -> list[list[float]]:
        out = []
        for text in texts:
            words = (w.strip("'") for w in re.split(r"[^\w']+", text.lower()))
            known = [self.valences[w] for w in words if w in self.valences]
            mean = sum(known) / len(known) if known else 0.0
            out.append([-mean, self.threshold, mean])
        return out


def long_by_entity(
    df: DataFrame, entities: Sequence[str], keep: Sequence[str] = (), candidate: str = "candidate"
) -> DataFrame:
    """One row per mentioned entity: (keep..., candidate, sentiment_label)."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(e).alias(candidate),
                F.col(label_of(e)).alias("sentiment_label"),
                (F.col(mention(e)) == 1).alias("mentioned"),
            )
            for e in entities
        ]
    )
    return df.select(*keep, F.inline(pairs)).filter("mentioned").drop("mentioned")
