"""Runs: score the texts, build a feature table, fit and evaluate a model."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.measures import DEFAULT_THRESHOLD
from moodline.operators import boosting
from moodline.operators.evaluation import evaluate
from moodline.operators.labels import (
    FORECAST,
    MARKET,
    TEST,
    TRADE_COLUMNS,
    TRAIN,
    LabelTables,
    label_series,
)
from moodline.operators.lexicon import Scorer, compound_scorer, polarity_scorer
from moodline.operators.models import MODELS, TREES, Fit, feature_columns, fit_model, fit_trees, target_of
from moodline.operators.moments import FROM_MOMENTS, INTERCEPT, moments
from moodline.operators.scoring import (
    AspectScorer,
    label_aspects,
    long_by_entity,
    score_mentions,
)
from moodline.plans.features import FEATURES, TWO_RATIOS, build_features
from moodline.schemas import label_of, mention, score_of
from moodline.session import stage
from moodline.sources.sinks import write_params

# Scorer names, batch sizes, and what "OLS" means in either split.
COMPOUND, POLARITY, ASPECT = "VADER", "TextBlob", "ABSA"
BATCH_SIZES = {TRAIN: 32, TEST: 16}
OLS_BY_SPLIT = {TRAIN: "OLS", TEST: "OLS no intercept"}
METRICS = (
    "n long, accuracy double, below_accuracy double, above_accuracy double, mae double, rmse double, "
    "r2 double, mape double"
)
POST_COLUMNS = ("country", "is_en", "likes", "user_join_date", "user_followers_count")


@dataclass(frozen=True)
class Run:
    """What one run does. Unknown names raise here, before any work."""

    entities: tuple[str, ...]
    sentiment: str = COMPOUND
    features: str = TWO_RATIOS
    model: str = "OLS"
    split: str = TRAIN
    threshold: float = DEFAULT_THRESHOLD
    label_type: str = FORECAST
    trade_type: str = "close"
    market_only: bool = False  # market labels, whatever the label type
    rolling: bool = False
    drop_missing: bool = False  # days on which a feature has no value, instead of an error
    model_options: Mapping[str, object] = field(default_factory=dict)
    feature_options: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        known = {
            "sentiment": self.sentiment in (COMPOUND, POLARITY, ASPECT),
            "features": (self.split, self.features) in FEATURES,
            "model": self.model in MODELS,
            "label_type": self.label_type in (FORECAST, MARKET),
            "trade_type": self.trade_type in TRADE_COLUMNS,
        }
        for name, found in known.items():
            if not found:
                raise ValueError(f"unknown {name}: {getattr(self, name)!r} (split {self.split!r})")


@dataclass(frozen=True)
class Scorers:
    """The word tables and the aspect scorer that runs may use."""

    valences: DataFrame | None = None
    polarities: DataFrame | None = None
    aspect: AspectScorer | None = None

    def lexicon_scorer(self, name: str) -> Scorer:
        makers = {
            COMPOUND: lambda: compound_scorer(self.valences),
            POLARITY: lambda: polarity_scorer(self.polarities),
        }
        if name not in makers:
            raise ValueError(f"unknown sentiment scorer: {name!r}")
        return makers[name]()


def score_texts(
    processed: DataFrame, run: Run, scorers: Scorers, *, carry: Sequence[str] = ()
) -> DataFrame:
    """Sentiment columns per entity: (carry..., timestamp, post columns, flags, labels, scores).

    Posts are scored if they are English; articles have no language flag.
    """
    texts = processed.filter("is_en") if run.split == TRAIN else processed
    if run.sentiment == ASPECT:
        scored = label_aspects(
            texts, scorers.aspect, run.entities, batch_size=BATCH_SIZES[run.split]
        )
        scores = []
    else:
        scored = score_mentions(
            texts,
            scorers.lexicon_scorer(run.sentiment),
            run.entities,
            threshold=run.threshold,
        )
        scores = [score_of(e) for e in run.entities]
    posts = [c for c in POST_COLUMNS if run.split == TRAIN and c in scored.columns]
    return scored.select(
        *carry,
        "timestamp",
        *posts,
        *[label_of(e) for e in run.entities],
        *[mention(e) for e in run.entities],
        *scores,
    )


def feature_table(sentiment: DataFrame, labels: DataFrame, run: Run) -> DataFrame:
    """The run's feature table from its sentiment columns."""
    if run.split == TRAIN:
        keep = [c for c in ("timestamp", *POST_COLUMNS) if c in sentiment.columns]
        sentiment = long_by_entity(sentiment, run.entities, keep)
    return build_features(
        sentiment, labels, run.entities, run.features, split=run.split, **run.feature_options
    )


def fit_run(features: DataFrame, run: Run) -> Fit:
    name = OLS_BY_SPLIT[run.split] if run.model == "OLS" else run.model
    return fit_model(features, name, rolling=run.rolling, **run.model_options)


def _linear_predictions(table: DataFrame, runs: Sequence[Run]) -> list[tuple[Column, Column]]:
    """(truth, prediction) of linear runs, all solved from one pass over their feature table."""
    targets = {target_of(run.rolling) for run in runs}
    inputs = {t: feature_columns(table, t) for t in targets}
    found = moments(table, [*dict.fromkeys([*targets, *(c for columns in inputs.values() for c in columns)])])
    pairs = []
    for run in runs:
        target = target_of(run.rolling)
        name = OLS_BY_SPLIT[run.split] if run.model == "OLS" else run.model
        solved = FROM_MOMENTS[name](found, target, inputs[target], **run.model_options)
        truth = F.col(target).cast("double")
        # without an intercept a missing label counts as 0, as in the fit
        truth = truth if INTERCEPT in solved.betas else F.coalesce(truth, F.lit(0.0))
        pairs.append((truth, solved.column()))
    return pairs


def _boosted_predictions(table: DataFrame, runs: Sequence[Run]) -> list[tuple[Column, Column]]:
    """(truth, prediction) of boosting runs; those that differ in the number of trees share one fit."""
    fitted: dict[tuple, tuple[list[str], boosting.Boosted]] = {}

    def key(run: Run) -> tuple:
        return (run.rolling, *sorted((k, v) for k, v in run.model_options.items() if k != "n_estimators"))

    def trees(run: Run) -> int:
        return int(run.model_options.get("n_estimators", TREES))

    pairs = []
    for run in runs:
        target = target_of(run.rolling)
        if key(run) not in fitted:
            most = max(trees(r) for r in runs if key(r) == key(run))
            names = feature_columns(table, target)
            options = {k: v for k, v in run.model_options.items() if k != "n_estimators"}
            fitted[key(run)] = names, fit_trees(table, target, names, n_estimators=most, **options)
        names, model = fitted[key(run)]
        pairs.append((F.col(target).cast("double"), boosting.prediction(names, model.first(trees(run)))))
    return pairs


#: Models whose runs on one feature table are fitted together.
TOGETHER = {**dict.fromkeys(FROM_MOMENTS, _linear_predictions), "Gradient Boosting": _boosted_predictions}


def fits_together(table: DataFrame, runs: Sequence[Run]) -> list[tuple[Run, Sequence]]:
    """Metrics of runs of ``TOGETHER`` models on one feature table.

    Moments take one pass over the table, trees three for each set of options; the predictions of all
    runs are evaluated in one more.
    """
    done: list[tuple[Run, Column, Column]] = []
    for fit in dict.fromkeys(TOGETHER.values()):
        own = [r for r in runs if TOGETHER[r.model] is fit]
        done += [(r, *pair) for r, pair in zip(own, fit(table, own) if own else [], strict=True)]
    pairs = [
        F.struct(F.lit(place).alias("place"), truth.alias("truth"), guess.alias("prediction"))
        for place, (_, truth, guess) in enumerate(done)
    ]
    if not pairs:
        return []
    found = evaluate(table.select(F.inline(F.array(*pairs))), "truth", by=["place"]).collect()  # a row per run
    if len(found) < len(done):
        raise ValueError("no rows to fit on")
    return [(done[row["place"]][0], row[1:]) for row in sorted(found)]


def execute(
    processed: DataFrame | None,
    tables: LabelTables,
    run: Run,
    scorers: Scorers,
    *,
    sentiment: DataFrame | None = None,
    params_root: str | None = None,
) -> tuple[Fit, DataFrame]:
    """One run: the fit and its one-row metrics. A stored ``sentiment`` table skips scoring.
    Coefficients, where the model has some, are stored below ``params_root``.

    The feature table, a row per day, is stored before the fit: a fit reads its input
    many times and must not go back to the texts.
    """
    labels = label_series(
        tables, run.label_type, run.trade_type, split=run.split, market_only=run.market_only
    )
    if sentiment is None:
        sentiment = score_texts(processed, run, scorers)
    features = stage(feature_table(sentiment, labels, run), "features")
    if run.drop_missing:
        features = features.dropna()
    fit = fit_run(features, run)
    if params_root is not None and fit.betas:
        write_params(fit, params_root, run.split, run.sentiment, run.features)
    return fit, evaluate(fit.predictions, fit.label)


def description(run: Run) -> dict[str, str]:
    """The names of a run; models are judged on their own input."""
    return {
        "split": run.split,
        "sentiment": run.sentiment,
        "features": run.features,
        "model": run.model,
        "options": ", ".join(f"{k}={v}" for k, v in sorted(run.model_options.items())),
        "evaluated_on": "train",
    }


def describe(run: Run, metrics: DataFrame) -> DataFrame:
    """Metrics with the names of the run in front."""
    return metrics.select(*[F.lit(v).alias(k) for k, v in description(run).items()], "*")


def scenario_grid(
    processed: DataFrame,
    tables: LabelTables,
    scorers: Scorers,
    base: Run,
    *,
    sentiments: Iterable[str],
    features: Iterable[str],
    models: Sequence[tuple[str, Mapping[str, object]]],
    parallelism: int = 4,
) -> DataFrame:
    """All combinations as one table of metrics.

    Texts are scored once per scorer and rolled up once per feature set. All linear models of a
    feature table are solved from one pass over it, and so are trees of any number; every other model is
    fitted on the stored daily table. Those fits are small and independent jobs, so some run side by side.
    """
    labels = label_series(
        tables, base.label_type, base.trade_type, split=base.split, market_only=base.market_only
    )
    jobs: list[tuple[DataFrame, Run]] = []
    rows: list[tuple] = []
    feature_sets = list(features)
    for name in sentiments:
        scoring = replace(base, sentiment=name)
        scored = score_texts(processed, scoring, scorers)
        if len(feature_sets) > 1:
            scored = stage(scored, "sentiment")
        for feature_set in feature_sets:
            shaped = replace(scoring, features=feature_set)
            table = stage(feature_table(scored, labels, shaped), "features")
            if base.drop_missing:
                table = table.dropna()
            runs = [replace(shaped, model=model, model_options=options) for model, options in models]
            together = fits_together(table, [r for r in runs if r.model in TOGETHER])
            rows += [(*description(r).values(), *row) for r, row in together]
            jobs += [(table, r) for r in runs if r.model not in TOGETHER]

    def metrics(job: tuple[DataFrame, Run]) -> tuple:
        fit = fit_run(*job)
        return (*description(job[1]).values(), *evaluate(fit.predictions, fit.label).first())

    spark = processed.sparkSession
    with ThreadPoolExecutor(parallelism) as pool:
        rows += pool.map(inheritable_thread_target(spark)(metrics), jobs)
    names = ", ".join(f"{k} string" for k in description(base))
    return spark.createDataFrame(rows, f"{names}, {METRICS}")
