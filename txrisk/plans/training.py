"""Train on one side of a split, measure on the other."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions import all_present
from txrisk.operators import evaluate, labels
from txrisk.operators.features import TRANSACTION_FEATURES, FeatureSpec
from txrisk.operators.labels import ClassWeights
from txrisk.plans import models
from txrisk.plans.models import ModelSpec
from txrisk.storage import materialize


@dataclass(frozen=True)
class TrainingRun:
    """A fitted model with the numbers that describe its training data."""

    spec: ModelSpec
    model: PipelineModel
    weights: ClassWeights
    n_train: int
    n_dropped: int
    report: DataFrame


def _training_stats(df: DataFrame, inputs: FeatureSpec, label: str, weights_from: str):
    """Class weights, usable training rows and dropped rows, from one aggregate."""
    train = F.col("__train")
    usable = F.col(label).isNotNull() & all_present(inputs.numeric)
    counted = F.lit(True) if weights_from == "all" else train
    n_pos, n_neg = F.col("n_pos"), F.col("n_neg")
    row = (
        df.agg(
            F.count_if(counted & (F.col(label) == 1)).alias("n_pos"),
            F.count_if(counted & (F.col(label) == 0)).alias("n_neg"),
            F.count_if(train & usable).alias("n_usable"),
            F.count_if(train & ~usable).alias("n_dropped"),
        )
        .withColumns(
            {
                "weight_pos": labels.balanced_weight(n_pos, n_neg),
                "weight_neg": labels.balanced_weight(n_neg, n_pos),
            }
        )
        .first()
    )
    weights = ClassWeights(row.n_pos, row.n_neg, row.weight_pos, row.weight_neg)
    return weights, row.n_usable, row.n_dropped


def train_and_evaluate(
    df: DataFrame,
    spec: ModelSpec,
    inputs: FeatureSpec = TRANSACTION_FEATURES,
    *,
    is_train: str,
    label: str = "label",
    weights_from: str = "all",
    stage_at: str | None = None,
    partitions: int | None = None,
    max_categories: int = 10_000,
    hash_slots: int = 0,
    after_staging: Callable[[], None] | None = None,
) -> TrainingRun:
    """Fit ``spec`` on the rows where ``is_train`` (an SQL condition) holds, test on the others.

    ``weights_from="all"`` takes the class weights from all rows, test rows included;
    ``"train"`` from the training side alone. Rows that cannot be trained on are left out
    of the fit and counted in ``n_dropped``; they stay in the evaluation.

    With ``stage_at`` the columns in use are first written there, a folder that all
    executors share, and counting, fitting and testing read that table: a CSV is then
    parsed once, each side is read without the other, and fitting again on the same table
    sees the same row order. ``after_staging`` is called when that is done, before anything is counted: the place to refuse
    a table by the :class:`txrisk.sources.files.CellQuality` of its CSV. ``partitions`` fixes the layout for every cluster, see
    :func:`txrisk.plans.models.train`.
    """
    if weights_from not in ("all", "train"):
        raise ValueError("weights_from is 'all' or 'train'")
    side = F.coalesce(F.expr(is_train), F.lit(False)).alias("__train")
    marked = df.select(*inputs.inputs, label, side)
    if stage_at:
        marked = materialize(marked, stage_at, "__train")
        if after_staging:
            after_staging()
    weights, n_train, n_dropped = _training_stats(marked, inputs, label, weights_from)
    if n_train == 0:
        raise ValueError("no usable training rows")
    weighted = labels.with_weight(marked, weights, label)
    model = models.train(
        weighted.filter("__train"),
        spec,
        inputs,
        label=label,
        partitions=partitions,
        max_categories=max_categories,
        hash_slots=hash_slots,
    )
    test = marked.filter(~F.col("__train")).select(label, *inputs.inputs)
    scored = models.score(model, test, inputs)
    used = weights if spec.weighted else None
    report = evaluate.report(scored, spec.name, used, label)
    return TrainingRun(spec, model, weights, n_train, n_dropped, report)
