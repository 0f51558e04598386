"""Language identification by character trigrams (naive Bayes, add-one smoothing).

Cavnar & Trenkle (1994) style profiles. With ``c`` the count of a trigram in a
language, ``N`` that language's total and ``V`` the number of distinct trigrams,
its log probability is ``ln(c + 1) - ln(N + V)``. The second part is the same for
every trigram of a language, so a text scores ``sum ln(c + 1) - n * ln(N + V)`` and
trigrams never seen need no row in the profile.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.text import letters_only, trigrams
from moodline.operators.lookup import MAX_ROWS, fits_broadcast, lookup_join
from moodline.session import stage

# Code of this module travels to the Python workers with the job, so they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _count(language: str) -> str:
    return f"count_{language}"


@dataclass(frozen=True)
class LanguageProfiles:
    grams: DataFrame  # gram, one count column per language; a stage table
    languages: tuple[str, ...]  # in name order, which also breaks ties
    log_totals: dict[str, float]


def _codes(texts: str) -> np.ndarray:
    """Each trigram of a string as one integer, 21 bits per character."""
    points = np.frombuffer(texts.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    return (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]


def _gram(code: int) -> str:
    return "".join(chr(code >> shift & 0x1FFFFF) for shift in (42, 21, 0))


BLANKS = np.uint64(ord(" ") << 21 | ord(" "))
PAIR = np.uint64((1 << 42) - 1)


def count_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, letters) rows -> (lang, gram, n), counted within each batch.

    Every text starts and ends with a blank and has no two blanks in a row, so the
    trigrams that span two texts are just those with a pair of blanks.
    """
    for batch in batches:
        for lang, letters in batch.groupby("lang")["letters"]:
            codes = _codes("".join(letters))
            whole = ((codes >> np.uint64(21)) != BLANKS) & ((codes & PAIR) != BLANKS)
            grams, n = np.unique(codes[whole], return_counts=True)
            yield pd.DataFrame({"lang": lang, "gram": [_gram(int(c)) for c in grams], "n": n})


def build_profiles(
    df: DataFrame, text: str, language: str, languages: Sequence[str]
) -> LanguageProfiles:
    """Count trigrams per language over labelled texts.

    Counted per Arrow batch first, which leaves a few thousand rows for thousands of
    texts; those are added up by Spark.
    """
    languages = tuple(sorted(languages))
    counts = (
        df.filter(F.col(language).isin(*languages) & F.col(text).isNotNull())
        .select(F.col(language).alias("lang"), letters_only(text).alias("letters"))
        .mapInPandas(count_batch, "lang string, gram string, n long")
        .groupBy("gram")
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("lang") == l, F.col("n"))), F.lit(0)).alias(_count(l))
                for l in languages
            ]
        )
    )
    grams = stage(counts, "language-profiles")
    totals = grams.agg(
        F.count(F.lit(1)).alias("distinct"),
        *[F.coalesce(F.sum(_count(l)), F.lit(0)).alias(l) for l in languages],
    ).select(
        *[
            F.ln(F.greatest(F.col(l) + F.col("distinct"), F.lit(1)).cast("double")).alias(l)
            for l in languages
        ]
    )
    return LanguageProfiles(grams, languages, totals.first().asDict())


def profile_table(profiles: LanguageProfiles) -> DataFrame:
    """(lang, gram, n, log_prob) of the trigrams each language has."""
    rows = F.array(
        *[
            F.struct(
                F.lit(l).alias("lang"),
                F.col(_count(l)).alias("n"),
                (
                    F.ln((F.col(_count(l)) + 1).cast("double")) - F.lit(profiles.log_totals[l])
                ).alias("log_prob"),
            )
            for l in profiles.languages
        ]
    )
    return profiles.grams.select("gram", F.inline(rows)).filter("n > 0")


def _weights(profiles: LanguageProfiles) -> DataFrame:
    return profiles.grams.select(
        "gram", *[F.ln((F.col(_count(l)) + 1).cast("double")).alias(l) for l in profiles.languages]
    )


def detect_by_join(df: DataFrame, profiles: LanguageProfiles, key: str, text: str) -> DataFrame:
    """(key, language) of every text that has a trigram; for profiles of any size."""
    pieces = df.select(F.col(key), F.explode(trigrams(text)).alias("gram"))
    scores = (
        lookup_join(pieces, _weights(profiles), "gram", how="left", spread=key)
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.sum(F.coalesce(F.col(l), F.lit(0.0))).alias(l) for l in profiles.languages],
        )
        .select(
            key,
            *[
                (F.col(l) - F.col("_n") * F.lit(profiles.log_totals[l])).alias(l)
                for l in profiles.languages
            ],
        )
    )
    best = F.array_max(F.array(*profiles.languages))
    named = F.coalesce(*[F.when(F.col(l) == best, F.lit(l)) for l in profiles.languages])
    return scores.select(key, named.alias("language"))


def row_detector(profiles: LanguageProfiles) -> Callable[[Column], Column]:
    """A column function text -> language, for profiles proven small enough to broadcast.

    Scoring needs a table lookup per character, which no built-in expression does
    within a row. Exploding a text into its trigrams does it by join, at several times
    the cost and with a shuffle to put the rows together again; here the table travels
    to the tasks and a text is scored where it is.
    """
    table = _weights(profiles).toPandas()
    codes = np.array([int(_codes(g)[0]) for g in table["gram"]], dtype=np.uint64)
    order = np.argsort(codes)
    # one row more, of zeros, for trigrams the profiles do not have
    weights = np.vstack([table[list(profiles.languages)].to_numpy()[order], np.zeros(len(profiles.languages))])
    sent = profiles.grams.sparkSession.sparkContext.broadcast(
        (
            codes[order],
            weights,
            np.array([profiles.log_totals[l] for l in profiles.languages]),
            np.array(profiles.languages, dtype=object),
        )
    )

    @F.pandas_udf("string")
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, gains, log_totals, names = sent.value
        for texts in batches:
            found = [None] * len(texts)
            for place, text in enumerate(texts):
                if text is None or len(text) < 3:
                    continue
                grams, counts = np.unique(_codes(text), return_counts=True)
                at = np.searchsorted(known, grams)
                at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != grams)] = len(known)
                scores = counts @ gains[at] - counts.sum() * log_totals
                found[place] = names[np.argmax(scores)]
            yield pd.Series(found, dtype="object")

    return lambda text: detect(letters_only(text))


def flag_language(
    df: DataFrame,
    profiles: LanguageProfiles,
    *,
    text: str,
    language: str = "en",
    flag: str = "is_en",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add whether each text is in the language; texts without letters are not."""
    if fits_broadcast(profiles.grams, max_rows):
        hit = row_detector(profiles)(F.col(text)) == language
        return df.withColumn(flag, F.coalesce(hit, F.lit(False)))
    # by row, as in place: keys may repeat or be null
    rows = stage(df.withColumn("_row_number", F.monotonically_increasing_id()), "language-rows")
    found = detect_by_join(rows, profiles, "_row_number", text).select(
        "_row_number", (F.col("language") == language).alias("_hit")
    )
    return (
        rows.join(found, "_row_number", "left")
        .withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False)))
        .drop("_hit", "_row_number")
    )
