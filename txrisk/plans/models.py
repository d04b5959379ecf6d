"""The six classifier variants, training and scoring."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions import all_present, p_positive
from txrisk.operators import features
from txrisk.operators.features import TRANSACTION_FEATURES, FeatureSpec, Labels

# Hyper-parameters of each algorithm; everything else keeps Spark's default.
PARAMETERS: dict[str, dict[str, Any]] = {
    "gbt": {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1, "seed": 42},
    "lr": {"maxIter": 20, "regParam": 0.0, "elasticNetParam": 0.0},
    "rf": {"numTrees": 20, "maxDepth": 6, "seed": 42},
}
CLASSIFIERS = {"gbt": GBTClassifier, "lr": LogisticRegression, "rf": RandomForestClassifier}

@dataclass(frozen=True)
class ModelSpec:
    """One algorithm, with or without class weights."""

    algo: str
    weighted: bool
    parameters: dict[str, Any] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.algo}_{'weighted' if self.weighted else 'unweighted'}"

    def classifier(self, features_col: str, label: str, weight: str):
        settings = {**PARAMETERS[self.algo], **self.parameters}
        if self.weighted:
            settings["weightCol"] = weight
        return CLASSIFIERS[self.algo](featuresCol=features_col, labelCol=label, **settings)


SPECS = {
    (algo, weighted): ModelSpec(algo, weighted) for algo in PARAMETERS for weighted in (True, False)
}


def build(
    spec: ModelSpec,
    inputs: FeatureSpec = TRANSACTION_FEATURES,
    labels: list[Labels] | None = None,
    label: str = "label",
    weight: str = "weight",
) -> Pipeline:
    """Unfitted pipeline: indexer, one-hot encoder, assembler, classifier."""
    classifier = spec.classifier(inputs.output, label, weight)
    return Pipeline(stages=[*features.stages(inputs, labels), classifier])


def trainable(
    df: DataFrame,
    spec: ModelSpec,
    inputs: FeatureSpec = TRANSACTION_FEATURES,
    label: str = "label",
    weight: str = "weight",
) -> DataFrame:
    """The columns a fit reads, without rows it cannot use (null label, null or NaN number)."""
    columns = [*inputs.inputs, label, *([weight] if spec.weighted else [])]
    return df.select(*columns).filter(F.col(label).isNotNull() & all_present(inputs.numeric))


@contextmanager
def _held(frame: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame on the executors, memory first, for the passes of one fit.

    Its lineage is a scan, narrow steps and at most one shuffle, so partitions lost
    with an executor are computed again from the source.
    """
    held = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _alone(model: Any) -> Any:
    """The model without its training summary, as it is after saving and loading.

    A summary refers to the session, which cannot be sent to executors any more once the session has observed a write,
    so a model that keeps it could not score after the first measured batch.
    """
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def train(
    df: DataFrame,
    spec: ModelSpec,
    inputs: FeatureSpec = TRANSACTION_FEATURES,
    *,
    label: str = "label",
    weight: str = "weight",
    partitions: int | None = None,
    max_categories: int = 10_000,
    hash_slots: int = 0,
) -> PipelineModel:
    """Fit one variant.

    Tree training depends on which rows share a partition and on their order in it. By default those are
    the input's own, so that two fits of one written table agree where it is split alike. With
    ``partitions`` rows are placed by a hash of all columns that are read and sorted by them: a shuffle, after which
    the model is the same on every cluster and for every layout of the input. Nothing depends on the
    number of rows or cores.

    ``hash_slots`` lets columns have more than ``max_categories`` values, see :func:`txrisk.operators.features.fit_labels`.

    The data is read twice: for the category counts, then for the vectors. These are held for
    trees, which pass over them several times before they build their own copy.
    """
    frame = trainable(df, spec, inputs, label, weight)
    if partitions is not None:
        frame = frame.repartition(partitions, *frame.columns).sortWithinPartitions(*frame.columns)
    *encoders, classifier = build(
        spec, inputs, features.fit_labels(frame, inputs, max_categories, hash_slots), label, weight
    ).getStages()
    encoding = Pipeline(stages=encoders).fit(frame)
    kept = [inputs.output, label, *([weight] if spec.weighted else [])]
    vectors = encoding.transform(frame).select(*kept)
    if spec.algo == "lr":
        return PipelineModel([*encoding.stages, _alone(classifier.fit(vectors))])
    with _held(vectors) as vectors:
        return PipelineModel([*encoding.stages, _alone(classifier.fit(vectors))])


def score(
    model: PipelineModel, df: DataFrame, inputs: FeatureSpec = TRANSACTION_FEATURES
) -> DataFrame:
    """Add ``rawPrediction, probability, prediction, p_fraud, features_ok``; batch or stream.

    ``features_ok`` is false where a number is missing: trees still answer there, but
    logistic regression returns NaN probabilities with prediction 0.
    """
    scored = model.transform(df).drop(*inputs.intermediate)
    return scored.withColumns(
        {"p_fraud": p_positive(), "features_ok": all_present(inputs.numeric)}
    )
