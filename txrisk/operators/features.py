"""Categories and numbers to one feature vector."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.schema import CATEGORICAL, NUMERIC


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns feed the model. Vector order is numeric, then one-hot, in list order."""

    numeric: tuple[str, ...] = NUMERIC
    categorical: tuple[str, ...] = CATEGORICAL
    output: str = "features"

    @property
    def inputs(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def index_columns(self) -> list[str]:
        return [f"{c}_idx" for c in self.categorical]

    @property
    def onehot_columns(self) -> list[str]:
        return [f"{c}_oh" for c in self.categorical]

    @property
    def intermediate(self) -> list[str]:
        hashing = [f"{c}_{kind}" for c in self.categorical for kind in ("label", "key")]
        return self.index_columns + self.onehot_columns + hashing


TRANSACTION_FEATURES = FeatureSpec()


def category_counts(df: DataFrame, spec: FeatureSpec = TRANSACTION_FEATURES, only: DataFrame | None = None) -> DataFrame:
    """Rows per category of every categorical column: ``feature, value, n``. Nulls excluded, and what ``only`` does not list.

    One scan for all columns, counted map-side before the shuffle, so a value that fills
    a third of the table costs one record per map task.
    """
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
        for c in spec.categorical
    ]
    values = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    if only is not None:
        values = values.join(only, ["feature", "value"], "left_semi")
    return values.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


class Labels(list):
    """Values of a column that have an index of their own, most frequent first, and how many ``slots`` the others share."""

    def __init__(self, values: Iterable[str] = (), slots: int = 0) -> None:
        super().__init__(values)
        self.slots = slots


def fit_labels(
    df: DataFrame, spec: FeatureSpec = TRANSACTION_FEATURES, max_categories: int = 10_000, hash_slots: int = 0
) -> list[Labels]:
    """Category labels per column, most frequent first, ties alphabetical.

    The same order as ``StringIndexer``. The labels become part of the model on every
    executor, so their number is checked while still distributed: a column with more than
    ``max_categories`` values is refused before anything is collected beyond the limit.

    With ``hash_slots`` such a column is not refused: its frequent values, those of at least one in ``max_categories``
    of its rows, keep labels of their own, and all others share that many slots by a hash. Candidates come from a
    frequent-items sketch that is merged on the executors, and are then counted exactly; the sketch misses none, so the
    labels are the same for every layout of the input.
    """
    bound = max_categories * len(spec.categorical)
    rows = category_counts(df, spec).limit(bound + 1).collect()
    counts: dict[str, list[tuple[int, str]]] = {c: [] for c in spec.categorical}
    for row in rows:
        counts[row.feature].append((-row.n, row.value))
    too_wide = [c for c, found in counts.items() if len(found) > max_categories]
    if (too_wide or len(rows) > bound) and not hash_slots:
        raise ValueError(
            f"more than {max_categories} categories in {', '.join(too_wide) or 'the table'}; "
            "group the values first, raise max_categories or give hash_slots"
        )
    if not too_wide and len(rows) <= bound:
        return [Labels([value for _, value in sorted(counts[c])]) for c in spec.categorical]
    return _frequent_labels(df, spec, max_categories, hash_slots)


def _frequent_labels(df: DataFrame, spec: FeatureSpec, max_categories: int, hash_slots: int) -> list[Labels]:
    # A sketch of m items counts short by 3.5 / m of the rows at most. With eight items per label, every value of a
    # share of 1 / max_categories is among those it gives back.
    tracked = min(8 * max_categories, 1_000_000)
    if tracked < 8 * max_categories:
        raise ValueError("max_categories is 125,000 at most where values are hashed")
    text = {c: f"cast(`{c}` AS string)" for c in spec.categorical}
    sketches = [F.expr(f"approx_top_k({text[c]}, {tracked}, {tracked})").alias(c) for c in spec.categorical]
    totals = [F.count(F.col(c)).alias(f"n_{i}") for i, c in enumerate(spec.categorical)]
    found = df.agg(*sketches, *totals).first()
    candidates = [(c, entry.item) for c in spec.categorical for entry in found[c] or [] if entry.item is not None]
    # At most `tracked` values per column, so small enough to be sent to every executor.
    known = df.sparkSession.createDataFrame(candidates, "feature string, value string")
    counted = category_counts(df, spec, F.broadcast(known)).collect()
    out = []
    for i, c in enumerate(spec.categorical):
        mine = sorted((-row.n, row.value) for row in counted if row.feature == c)
        if len(mine) <= max_categories and sum(-n for n, _ in mine) == found[f"n_{i}"]:
            out.append(Labels([value for _, value in mine]))  # all there are
        else:
            out.append(Labels([value for n, value in mine if -n * max_categories >= found[f"n_{i}"]], hash_slots))
    return out


def _slot(i: int) -> str:
    return f"\x00slot {i}"


def _hashed(column: str, first: str, key: str, labels: Labels) -> SQLTransformer:
    """Adds ``key``: the value itself where it has a label, else its slot."""
    digest = f"conv(substring(md5(cast(`{column}` AS string)), 1, 8), 16, 10)"
    value = (
        f"CASE WHEN `{column}` IS NULL THEN NULL WHEN `{first}` < {len(labels)} THEN cast(`{column}` AS string) "
        f"ELSE concat('\\u0000slot ', cast(cast({digest} AS bigint) % {labels.slots} AS string)) END"
    )
    return SQLTransformer(statement=f"SELECT *, {value} AS `{key}` FROM __THIS__")


def stages(
    spec: FeatureSpec = TRANSACTION_FEATURES, labels: list[Labels] | None = None
) -> list[Estimator | Transformer]:
    """One indexer per categorical column, one-hot encoder and assembler.

    With ``labels`` from :func:`fit_labels` the indexers need no pass of their own. Unseen
    and null categories take the index after the last label and keep a one-hot slot. Where labels have
    hash slots, unseen values take a slot by their hash, after the labels, and null the index after the slots.
    """
    indexers: list[Estimator | Transformer] = []
    for i, (source, index) in enumerate(zip(spec.categorical, spec.index_columns)):
        if labels is None:
            indexers.append(StringIndexer(inputCol=source, outputCol=index, handleInvalid="keep"))
            continue
        known = labels[i] if isinstance(labels[i], Labels) else Labels(labels[i])
        if not known.slots:
            indexers.append(StringIndexerModel.from_labels(list(known), source, index, handleInvalid="keep"))
            continue
        first, key = f"{source}_label", f"{source}_key"
        slots = [_slot(k) for k in range(known.slots)]
        indexers += [
            StringIndexerModel.from_labels(list(known) or [_slot(-1)], source, first, handleInvalid="keep"),
            _hashed(source, first, key, known),
            StringIndexerModel.from_labels([*known, *slots], key, index, handleInvalid="keep"),
        ]
    encoder = OneHotEncoder(
        inputCols=spec.index_columns, outputCols=spec.onehot_columns, dropLast=False
    )
    assembler = VectorAssembler(
        inputCols=[*spec.numeric, *spec.onehot_columns],
        outputCol=spec.output,
        handleInvalid="keep",
    )
    return [*indexers, encoder, assembler]


def vector_slots(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """Non-zero entries of a vector column as rows ``*keys, slot, value``."""
    entries = F.posexplode(vector_to_array(F.col(vector))).alias("slot", "value")
    return df.select(*keys, entries).filter(F.col("value") != 0)
