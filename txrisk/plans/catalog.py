"""Registered queries: each step of the pipeline over the whole test tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions import encode_record, parse_timestamp
from txrisk.operators import evaluate, features, labels, prep, split
from txrisk.operators.features import TRANSACTION_FEATURES, FeatureSpec
from txrisk.plans import models, registry, training
from txrisk.plans.models import ModelSpec
from txrisk.schema import CATEGORICAL, KAFKA_RECORD, PAYLOAD, UNINFORMATIVE
from txrisk.sources import files, fixtures
from txrisk.storage import materialize, scratch_path
from txrisk.streaming.decode import decode
from txrisk.streaming.progress import ProgressTable, read_progress
from txrisk.streaming.saved import CELLS, SavedPredictions
from txrisk.streaming.scoring import run_to_end, score_stream

Query = Callable[[SparkSession, str], DataFrame]

PREPARED = ["timestamp", "amount", "transaction_type", "merchant_category", "location",
            "device_used", "is_fraud", "hour_of_day", "day_of_week", "is_weekend"]
DOCUMENT_FEATURES = FeatureSpec(numeric=("n_chars",), categorical=("lang", "source"))
TRAIN_SIDE = "split = 'train'"
ROWS_PER_FILE, FILES_PER_BATCH = 2_500, 10  # of message streams of up to STREAM_ROWS
STREAM_ROWS = 100_000
MORE_FILES = 16  # a longer stream has up to so many times the files in a batch, then larger files
ROWS_PER_TRIGGER = 5_000_000
N_BATCHES = 200
MANY, SLOTS = 12, 32  # labels and hashed slots of a column with many values


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.with_label(fixtures.transactions(spark, sf_dir))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Preparation


def prep_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = fixtures.events(spark, sf_dir).select("event_id", F.col("ts").alias("timestamp"))
    return prep.with_calendar(ts)


def prep_mixed_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.raw_transactions(spark, sf_dir)
    dropped = [c for c in UNINFORMATIVE if c != "transaction_id"]
    return prep.prepare(raw, drop=dropped).select("transaction_id", "timestamp")


def prep_timestamp_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine ways to write an instant, a different one from row to row."""
    log = fixtures.events(spark, sf_dir)
    return log.select("event_id", parse_timestamp(fixtures.timestamp_forms(F.col("ts"), F.col("event_id"))).alias("timestamp"))


def prep_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.drop_uninformative(fixtures.raw_transactions(spark, sf_dir))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_path, prepared_path = scratch_path(spark, "raw"), scratch_path(spark, "prepared")
    fixtures.raw_transactions(spark, sf_dir).write.option("header", True).csv(raw_path)
    files.write_prepared(prep.prepare(files.read_raw(spark, raw_path)), prepared_path)
    return files.read_transactions(spark, prepared_path).select(PREPARED)


def csv_cell_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a CSV that do not fit their columns, as counted while it is written as a table, and as kept with the rows."""
    path = scratch_path(spark, "dirty")
    fixtures.dirty_csv(spark, sf_dir).write.option("header", True).csv(path)
    quality = files.CellQuality()
    table = files.read_transactions(spark, path, quality=quality, unreadable="unreadable")
    table = materialize(table, scratch_path(spark, "table"))
    aside = table.filter("unreadable is not null").select(F.explode(F.map_keys(F.from_json("unreadable", "map<string, string>"))).alias("column"))
    kept = aside.groupBy("column").agg(F.count(F.lit(1)).alias("n_kept"))
    told = spark.createDataFrame([(c, n, quality.n_bad_rows) for c, n in quality.n_bad.items()], "column string, n_bad long, n_bad_rows long")
    return told.join(kept, "column", "left").select("column", "n_bad", F.coalesce("n_kept", F.lit(0)).alias("n_kept"), "n_bad_rows")


def csv_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of a CSV's columns, as found, kept beside the file and read again."""
    path = scratch_path(spark, "mixed")
    fixtures.mixed_csv(spark, sf_dir).write.option("header", True).csv(path)
    files.save_types(spark, path, files.infer_types(spark, path))
    rows = [(name, kind.simpleString()) for name, kind in files.load_types(spark, path).items()]
    return spark.createDataFrame(rows, "column string, type string")


# Labels, weights, splits


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.class_counts(_labelled(spark, sf_dir))


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(labels.class_weights(_labelled(spark, sf_dir)), "weight_pos", "weight_neg")


def class_weights_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = labels.class_weights(_labelled(spark, sf_dir), by=["split"])
    return _rounded(weights, "weight_pos", "weight_neg")


def weighted_class_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _labelled(spark, sf_dir)
    weighted = labels.with_weight(df, labels.fit_class_weights(df))
    totals = weighted.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("weight").alias("total_weight")
    )
    return _rounded(totals, "total_weight")


def document_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labels.with_label(fixtures.labelled_documents(spark, sf_dir), "toxic")
    return _rounded(labels.class_weights(df, by=["lang"]), "weight_pos", "weight_neg")


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.with_split(
        fixtures.events(spark, sf_dir).select(F.col("event_id").alias("transaction_id")),
        "transaction_id",
    )


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split.random_split(fixtures.events(spark, sf_dir).select("event_id"))
    sides = train.withColumn("is_train", F.lit(1)).union(test.withColumn("is_train", F.lit(0)))
    totals = sides.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("event_id").alias("sum_ids"),
        F.avg("is_train").alias("share"),
    )
    near = F.col("share").between(0.75, 0.85).cast("int")
    return totals.select("n_rows", "sum_ids", near.alias("share_ok"))


# Features


def _feature_pipeline(df: DataFrame, inputs: FeatureSpec = TRANSACTION_FEATURES) -> PipelineModel:
    return Pipeline(stages=features.stages(inputs, features.fit_labels(df, inputs))).fit(df)


def _per_category(df: DataFrame, suffix: str, **extra: Column) -> DataFrame:
    """One row per input row and categorical column: feature, text value, derived value."""
    pairs = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).alias("value"),
            (vector_to_array(f"{c}_oh") if suffix == "oh" else F.col(f"{c}_idx")).alias(suffix),
        )
        for c in CATEGORICAL
    ]
    return df.select("transaction_id", F.inline(F.array(*pairs)))


def index_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.transactions(spark, sf_dir)
    indexed = _per_category(_feature_pipeline(df).transform(df), "idx")
    return indexed.groupBy("feature", "value", F.col("idx").cast("int").alias("idx")).agg(
        F.count(F.lit(1)).alias("n")
    )


def index_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes where the fit has not seen one location: it takes the index after the last."""
    df = fixtures.transactions(spark, sf_dir)
    fitted = _feature_pipeline(df.filter(F.col("location") != "Tokyo"))
    indexes = [F.col(c).cast("int").alias(c) for c in TRANSACTION_FEATURES.index_columns]
    return fitted.transform(df).select("transaction_id", *indexes)


def index_many_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes of a column with far more values than labels: frequent values have their own, the others share hashed slots."""
    df = fixtures.many_merchants(spark, sf_dir)
    inputs = FeatureSpec(numeric=(), categorical=("merchant",))
    found = features.fit_labels(df, inputs, max_categories=MANY, hash_slots=SLOTS)
    fitted = Pipeline(stages=features.stages(inputs, found)[:-1]).fit(df)
    encoded = fitted.transform(df)
    width = F.size(vector_to_array("merchant_oh"))
    return encoded.select("transaction_id", F.col("merchant_idx").cast("int").alias("idx"), width.alias("width"))


def onehot_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.transactions(spark, sf_dir)
    encoded = _per_category(_feature_pipeline(df).transform(df), "oh")
    slots = encoded.select(
        "transaction_id", "feature", F.size("oh").alias("width"), F.posexplode("oh")
    )
    return slots.filter(F.col("col") != 0).select(
        "transaction_id", "feature", "width", F.col("pos").alias("slot")
    )


def feature_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.transactions(spark, sf_dir)
    return features.vector_slots(_feature_pipeline(df).transform(df), "features", "transaction_id")


# Evaluation


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion(fixtures.rule_predictions(spark, sf_dir))


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = evaluate.metrics(evaluate.confusion(fixtures.rule_predictions(spark, sf_dir)))
    return _rounded(measured, "accuracy", "precision", "recall", "f1")


def metrics_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = fixtures.rule_predictions(spark, sf_dir)
    measured = evaluate.metrics(evaluate.confusion(predictions, by=["transaction_type"]))
    return _rounded(measured, "accuracy", "precision", "recall", "f1")


def metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = fixtures.rule_predictions(spark, sf_dir)
    weights = labels.fit_class_weights(predictions)
    measured = evaluate.report(predictions, "rule", weights)
    return _rounded(measured, *[n for n, kind in measured.dtypes if kind == "double"])


def batch_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = fixtures.rule_predictions(spark, sf_dir)
    return _rounded(evaluate.batch_accuracy(predictions, "label", by=["batch_id"]), "accuracy")


# Models


def _checked(
    table: DataFrame, spec: ModelSpec, inputs: FeatureSpec = TRANSACTION_FEATURES
) -> DataFrame:
    """Train, evaluate, and count what contradicts the fit; one row with class sizes, weights and counts.

    ``n_cells_off``: cells of the report that differ from a recount of the scored rows.
    ``n_fit_off``: violations of what the algorithm's optimum or construction requires.
    """
    run = training.train_and_evaluate(table, spec, inputs, is_train=TRAIN_SIDE)
    scored = models.score(run.model, table.filter(f"not ({TRAIN_SIDE})"), inputs)
    recount = scored.filter("label is not null").agg(
        F.sum(F.expr("int(label = 1 and prediction = 1)")).alias("tp"),
        F.sum(F.expr("int(label = 0 and prediction = 0)")).alias("tn"),
        F.sum(F.expr("int(label = 0 and prediction = 1)")).alias("fp"),
        F.sum(F.expr("int(label = 1 and prediction = 0)")).alias("fn"),
    ).first()
    off = sum((F.when(F.col(c) != F.lit(recount[c] or 0), 1).otherwise(0) for c in CELLS), F.lit(0))
    classifier = run.model.stages[-1]
    expected = {**models.PARAMETERS[spec.algo], **spec.parameters}
    n_unset = sum(classifier.getOrDefault(name) != value for name, value in expected.items())
    train = table.filter(TRAIN_SIDE)
    encoded = labels.with_weight(train, run.weights) if spec.weighted else train.withColumn("weight", F.lit(1.0))
    for stage in run.model.stages[:-1]:
        encoded = stage.transform(encoded)
    n_fit_off = FIT_CHECKS[spec.algo](classifier, encoded, scored) + n_unset
    return run.report.select(
        "model",
        "weight_pos",
        "weight_neg",
        (F.col("tp") + F.col("fn")).alias("n_pos"),
        (F.col("tn") + F.col("fp")).alias("n_neg"),
        "total",
        off.cast("long").alias("n_cells_off"),
        F.lit(n_fit_off).cast("long").alias("n_fit_off"),
    )


def _lr_off(model, train: DataFrame, scored: DataFrame) -> int:
    """Score equations: weighted residuals add up to about nothing, alone and times each input.

    Iterations stop before full convergence, so a share of 2 % of the total weight is allowed.
    """
    margin = F.aggregate(
        F.zip_with(vector_to_array("features"), F.array(*map(F.lit, model.coefficients.toArray().tolist())), lambda x, w: x * w),
        F.lit(float(model.intercept)),
        lambda total, x: total + x,
    )
    residual = F.col("weight") * (1 / (1 + F.exp(-margin)) - F.col("label"))
    sums = train.select(residual.alias("r"), "weight", F.posexplode(vector_to_array("features")).alias("j", "x"))
    by_input = sums.groupBy("j").agg(
        F.abs(F.sum(F.col("r") * F.col("x"))).alias("gradient"),
        F.sum(F.col("weight") * F.abs("x")).alias("scale"),
        F.abs(F.sum("r")).alias("alone"),
        F.sum("weight").alias("total"),
    )
    return by_input.filter("gradient > 0.02 * scale or alone > 0.02 * total").count()


def _of_leaves(model, value: Callable) -> list[list[float]]:
    """A value of every leaf of every tree, leaves from left to right."""

    def walk(node) -> list[float]:
        if node.subtreeDepth():
            return walk(node.leftChild()) + walk(node.rightChild())
        return [float(value(node))]

    return [walk(tree.rootNode()) for tree in model._java_obj.trees()]


def _leaf_values(model) -> list[list[float]]:
    """What every leaf of every boosted tree answers."""
    return _of_leaves(model, lambda node: node.prediction())


def _leaf_shares(model) -> list[list[float]]:
    """The share of fraud in every leaf of every tree of a forest."""
    return _of_leaves(model, lambda node: node.impurityStats().prob(1.0))


def _with_leaves(model, df: DataFrame) -> DataFrame:
    """Add ``leaves``: for every tree the number of the leaf that a row ends in, all trees in one call."""
    silent = {model.rawPredictionCol: "", model.probabilityCol: "", model.predictionCol: "", model.leafCol: "__leaves"}
    return model.copy(silent).transform(df).withColumn("leaves", vector_to_array("__leaves").cast("array<int>")).drop("__leaves")


def _held(values: list[float], leaf: Column) -> Column:
    return F.get(F.expr(f"array({', '.join(f'{v!r}D' for v in values)})"), leaf)


def _gbt_off(model, train: DataFrame, scored: DataFrame) -> int:
    """Leaves of every tree hold the weighted mean of what the trees before it left over.

    The first tree fits the labels, taken as -1 and 1; each later one the negative gradient of the loss where
    the trees before it, times their weights, have got to. Rows that end in the same leaves with the same label leave over the same.
    """
    values = _leaf_values(model)
    same = _with_leaves(model, train).groupBy("leaves", "label", "weight").agg(F.count(F.lit(1)).alias("n"))
    y = 2 * F.col("label") - 1
    grown = same.withColumn("margin", F.lit(0.0))
    ends = []
    for i, share in enumerate(model.treeWeights):
        target = y if i == 0 else 4 * y / (1 + F.exp(2 * y * F.col("margin")))
        held = _held(values[i], F.get("leaves", F.lit(i)))
        ends.append(F.struct(F.lit(i).alias("tree"), F.get("leaves", F.lit(i)).alias("leaf"), F.col(f"held_{i}").alias("held"), F.col(f"target_{i}").alias("target")))
        grown = grown.withColumns({f"target_{i}": target.cast("double"), f"held_{i}": held}).withColumn("margin", F.col("margin") + share * F.col(f"held_{i}"))
    # One record per tree and leaf is all that is shuffled of these.
    w = F.col("weight") * F.col("n")
    means = grown.select("weight", "n", F.inline(F.array(*ends))).groupBy("tree", "leaf", "held").agg((F.sum(w * F.col("target")) / F.sum(w)).alias("mean"))
    return means.filter(F.coalesce(F.abs(F.col("held") - F.col("mean")) > 1e-6, F.lit(True))).count()


def _leaves_off(model, train: DataFrame) -> int:
    """Leaves whose share of fraud differs from that of the training rows in them by more than sampling explains.

    A tree counts every row as often as a Poisson draw says, so the share in a leaf strays from that of its rows by a
    standard deviation of sqrt(sum of w**2 (y - mean)**2) / sum of w; six of those are allowed, and nothing in a pure leaf.
    Few rows stray further than that formula says, so leaves of under thirty count only if they are pure.
    """
    held = [(tree, leaf, share) for tree, shares in enumerate(_leaf_shares(model)) for leaf, share in enumerate(shares)]
    y, w = F.col("label").cast("double"), F.col("weight")
    # One record per tree and leaf is all that is shuffled. The outer form adds no filter on the leaves, which would find them twice.
    sums = _with_leaves(model, train).select("label", "weight", F.posexplode_outer("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").agg(
        F.sum(w).alias("w"), F.sum(w * y).alias("wy"), F.sum(w * w).alias("ww"), F.sum(w * w * y).alias("wwy"), F.count(F.lit(1)).alias("n"), F.sum(y).alias("n_pos")
    )
    sums = sums.join(F.broadcast(train.sparkSession.createDataFrame(held, "tree int, leaf int, held double")), ["tree", "leaf"], "left")
    mean = F.col("wy") / F.col("w")
    # y is 0 or 1, so that (y - mean)**2 sums up from the sums of w**2 and w**2 y.
    spread = F.sqrt(F.greatest(F.col("wwy") * (1 - 2 * mean) + F.col("ww") * mean * mean, F.lit(0.0))) / F.col("w")
    pure = (F.col("n_pos") == 0) | (F.col("n_pos") == F.col("n"))
    few = F.least(F.col("n_pos"), F.col("n") - F.col("n_pos")) < 30
    return sums.filter(F.col("held").isNull() | ((pure | ~few) & (F.abs(F.col("held") - mean) > 6 * spread + 1e-6))).count()


def _rf_off(model, train: DataFrame, scored: DataFrame) -> int:
    """Number and depth of trees, leaves that fit the training rows, and probabilities that are the mean of the trees' own."""
    n_trees, depth = models.PARAMETERS["rf"]["numTrees"], models.PARAMETERS["rf"]["maxDepth"]
    shares = _leaf_shares(model)
    votes = sum((_held(values, F.get("leaves", F.lit(i))) for i, values in enumerate(shares)), F.lit(0.0))
    # A filter would be moved below the column of leaves and find them once for every tree.
    differs = F.coalesce(_differs(F.col("p_fraud"), votes / n_trees), F.lit(True))
    wrong = _with_leaves(model, scored).agg(F.count_if(differs)).first()[0]
    return wrong + _leaves_off(model, train) + int(model.getNumTrees != n_trees) + sum(t.depth > depth for t in model.trees)


FIT_CHECKS = {"lr": _lr_off, "gbt": _gbt_off, "rf": _rf_off}


def train_eval(spark: SparkSession, sf_dir: str, *, spec: ModelSpec) -> DataFrame:
    table = materialize(_labelled(spark, sf_dir), scratch_path(spark, "training"))
    return _rounded(_checked(table, spec), "weight_pos", "weight_neg")


def train_eval_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labels.with_label(fixtures.labelled_documents(spark, sf_dir), "toxic")
    table = materialize(split.with_split(df, "doc_id"), scratch_path(spark, "training"))
    return _rounded(_checked(table, models.SPECS["lr", True], DOCUMENT_FEATURES), "weight_pos", "weight_neg")


def holdout_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for every variant whatever it predicts: class sizes and weights."""
    table = materialize(_labelled(spark, sf_dir), scratch_path(spark, "training"))
    reports = [
        training.train_and_evaluate(table, spec, is_train=TRAIN_SIDE).report
        for spec in models.SPECS.values()
    ]
    together = reports[0]
    for other in reports[1:]:
        together = together.union(other)
    totals = together.select(
        "model",
        (F.col("tp") + F.col("fn")).alias("n_pos"),
        (F.col("tn") + F.col("fp")).alias("n_neg"),
        "total",
        "weight_pos",
        "weight_neg",
    )
    return _rounded(totals, "weight_pos", "weight_neg")


def _fitted(spark: SparkSession, sf_dir: str, algo: str) -> tuple[PipelineModel, DataFrame]:
    """A weighted model of the training side, and all rows to score."""
    df = _labelled(spark, sf_dir)
    run = training.train_and_evaluate(df, models.SPECS[algo, True], is_train=TRAIN_SIDE)
    return run.model, df


def _violations(df: DataFrame, broken: Column) -> DataFrame:
    return df.agg(
        F.count_if(F.coalesce(broken, F.lit(True))).alias("n_bad"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _differs(a: Column, b: Column) -> Column:
    return F.abs(a - b) > 1e-9


def lr_probability_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability recomputed from the coefficients."""
    model, df = _fitted(spark, sf_dir, "lr")
    fitted = model.stages[-1]
    coefficients = F.array(*map(F.lit, fitted.coefficients.toArray().tolist()))
    products = F.zip_with(vector_to_array("features"), coefficients, lambda x, w: x * w)
    margin = F.aggregate(products, F.lit(float(fitted.intercept)), lambda total, x: total + x)
    scored = models.score(model, df)
    return _violations(scored, _differs(F.col("p_fraud"), 1 / (1 + F.exp(-margin))))


def gbt_margin_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability is the logistic function of twice the margin."""
    model, df = _fitted(spark, sf_dir, "gbt")
    raw = vector_to_array("rawPrediction")
    expected = 1 / (1 + F.exp(-2 * raw[1]))
    broken = _differs(F.col("p_fraud"), expected) | _differs(raw[0], -raw[1])
    return _violations(models.score(model, df), broken)


def probability_simplex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities lie in [0, 1], sum to one and decide the prediction."""
    model, df = _fitted(spark, sf_dir, "rf")
    p = vector_to_array("probability")
    broken = (
        _differs(p[0] + p[1], F.lit(1.0))
        | ~p[0].between(0.0, 1.0)
        | (F.col("prediction") != (p[1] > 0.5).cast("double"))
        | ~F.col("features_ok")
    )
    return _violations(models.score(model, df), broken)


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved and reloaded model answers as before."""
    model, df = _fitted(spark, sf_dir, "gbt")
    path = scratch_path(spark, "model")
    registry.save(model, path)
    before = models.score(model, df).select(
        *TRANSACTION_FEATURES.inputs, F.col("p_fraud").alias("before")
    )
    after = models.score(registry.load(path), before)
    return _violations(after, F.col("p_fraud") != F.col("before"))


# Messages


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.payload_rows(spark, sf_dir)
    messages = rows.select("transaction_id", encode_record(*PAYLOAD.names).alias("value"))
    return decode(messages, keep=["transaction_id"])


def json_decode_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.dirty_payloads(spark, sf_dir)
    return decode(messages, keep=["offset"]).withColumnRenamed("offset", "transaction_id")


# Streams


def _batching(n_rows: int, files_per_batch: int) -> tuple[int, int]:
    """Rows of a file and files of a batch, for a stream of that many rows: more files in a batch first, then larger ones."""
    longer = max(1, math.ceil(n_rows / STREAM_ROWS))
    more = min(longer, MORE_FILES)
    rows_per_file = ROWS_PER_FILE * math.ceil(longer / more)
    return rows_per_file, max(1, min(files_per_batch * more, ROWS_PER_TRIGGER // rows_per_file))


def _message_stream(spark: SparkSession, messages: DataFrame, files_per_batch: int = FILES_PER_BATCH) -> tuple[DataFrame, DataFrame]:
    """Messages as a file stream in Kafka's columns, some files in each batch; and the same files as a table.

    Stands in for the Kafka source, whose connector is a separate jar. Starting and committing a batch costs the same for few
    rows and for many, so a longer stream has larger batches, not more of them, until a batch has ``ROWS_PER_TRIGGER`` rows.
    """
    path = scratch_path(spark, "messages")
    rows_per_file, files_per_batch = _batching(messages.count(), files_per_batch)
    messages.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    stream = spark.readStream.schema(KAFKA_RECORD).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream, spark.read.schema(KAFKA_RECORD).parquet(path)


def _score_messages(
    spark: SparkSession, sf_dir: str, messages: DataFrame, model: PipelineModel | None = None, **settings
) -> tuple[str, DataFrame]:
    """Score messages as a stream with a weighted model; the path of the saved rows, and the messages as they were sent."""
    model = model or _fitted(spark, sf_dir, "gbt")[0]
    path = scratch_path(spark, "scored")
    keep = settings.pop("keep", [])
    stream, sent = _message_stream(spark, messages)
    query = score_stream(
        decode(stream, keep=keep),
        model,
        path,
        scratch_path(spark, "checkpoint"),
        trigger={"availableNow": True},
        keep=keep,
        **settings,
    )
    run_to_end(query)
    return path, sent


def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, _ = _message_stream(spark, fixtures.dirty_payloads(spark, sf_dir))
    path = scratch_path(spark, "decoded")
    query = (
        decode(stream, keep=["offset"])
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run_to_end(query)
    return spark.read.parquet(path).withColumnRenamed("offset", "transaction_id")


def _as_in_batch(saved: DataFrame, messages: DataFrame, model: PipelineModel) -> DataFrame:
    """Saved rows with ``same``: whether scoring their message as a batch gives the same answer."""
    batch = models.score(model, decode(messages, keep=["offset"])).select(
        "offset", F.col("prediction").alias("__prediction"), F.col("p_fraud").alias("__p")
    )
    same = (F.col("prediction") == F.col("__prediction")) & ~_differs(F.col("p_fraud"), F.col("__p"))
    return saved.join(batch, "offset", "left").withColumn("same", F.coalesce(same, F.lit(False)))


def stream_score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.dirty_payloads(spark, sf_dir)
    model, _ = _fitted(spark, sf_dir, "gbt")
    path, sent = _score_messages(spark, sf_dir, messages, model, keep=["offset"])
    valid = F.col("same")
    return _as_in_batch(spark.read.parquet(path), sent, model).select(
        F.col("offset").alias("transaction_id"),
        "decode_ok",
        "features_ok",
        valid.alias("has_score"),
        F.col("batch_id").isNotNull().alias("has_batch"),
    )


def stream_native_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.payloads(spark, sf_dir)
    model, _ = _fitted(spark, sf_dir, "gbt")
    path, sent = _score_messages(spark, sf_dir, messages, model, keep=["offset"], mode="native")
    valid = F.col("same")
    return _as_in_batch(spark.read.parquet(path), sent, model).select(
        F.col("offset").alias("transaction_id"), "amount", "is_fraud", valid.alias("has_score")
    )


def saved_predictions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.payloads(spark, sf_dir)
    model, _ = _fitted(spark, sf_dir, "gbt")
    path, sent = _score_messages(spark, sf_dir, messages, model, keep=["offset"])
    saved = files.read_predictions(spark, path, keep="offset long")
    valid = F.col("same")
    return _as_in_batch(saved, sent, model).select(*PAYLOAD.names, valid.alias("has_score"))


def saved_predictions_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures that the stream reported, against those recomputed from the saved table."""
    told: dict[int, dict] = {}
    path, _ = _score_messages(spark, sf_dir, fixtures.payloads(spark, sf_dir), on_batch=told.__setitem__)
    saved = files.read_predictions(spark, path)
    measured = evaluate.batch_accuracy(saved, by=["run_id", "batch_id"])
    reported = spark.createDataFrame(
        [(k, m["n_correct"], m["n_rows"]) for k, m in told.items()], "batch_id int, told_correct long, told_rows long"
    )
    differs = ~F.col("n_correct").eqNullSafe(F.col("told_correct")) | ~F.col("n_rows").eqNullSafe(F.col("told_rows"))
    return measured.join(reported, "batch_id", "full").agg(
        F.sum("n_rows").alias("n_rows"), F.count_if(differs).alias("n_poor_batches")
    )


def _commit_all(saved: SavedPredictions, rows: DataFrame, batches: range) -> None:
    """Commit batches side by side, each the rows of its number."""
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda b: saved.commit_batch(rows.filter(F.col("batch") == b).drop("batch"), "run", b), batches))


def saved_predictions_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hundred batches, packed half-way and with batches repeated before, after and between packs: rows and kept measures.

    The first attempt at every repeated batch has its scores turned round, which must not be seen afterwards.
    """
    rows = fixtures.payload_rows(spark, sf_dir).withColumn("prediction", (F.col("amount") > 20).cast("double"))
    rows = materialize(rows.withColumn("batch", (F.col("transaction_id") % N_BATCHES).cast("int")), scratch_path(spark, "batches"), "batch")
    wrong = rows.withColumn("prediction", 1 - F.col("prediction"))
    saved = SavedPredictions(spark, scratch_path(spark, "saved"))
    keep = "transaction_id long"
    _commit_all(saved, wrong, range(20))
    _commit_all(saved, rows, range(10))
    _commit_all(saved, wrong, range(20, 100))
    saved.pack()
    _commit_all(saved, rows, range(10, N_BATCHES))
    saved.pack()
    saved.vacuum(older_than_hours=0.0)
    _commit_all(saved, rows, range(190, N_BATCHES))
    told = saved.batches().select("batch_id", *(F.col(m).alias(f"told_{m}") for m in ("n_rows", "tp", "fp")))
    recount = saved.read(keep).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("transaction_id").alias("sum_ids"), F.sum("prediction").cast("long").alias("n_flagged"),
        F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day"),
    )
    return recount.join(told, "batch_id", "full")


def saved_predictions_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of a saved stream by its batches' commits alone, against a recount of its rows and what was told meanwhile."""
    path, progress = scratch_path(spark, "saved"), scratch_path(spark, "progress")
    model, _ = _fitted(spark, sf_dir, "gbt")
    stream, _ = _message_stream(spark, fixtures.payloads(spark, sf_dir), files_per_batch=1)
    listener = ProgressTable(spark, progress)
    spark.streams.addListener(listener)
    try:
        query = score_stream(decode(stream), model, path, scratch_path(spark, "checkpoint"), mode="saved", trigger={"availableNow": True})
        run_to_end(query)
        listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    saved = SavedPredictions(spark, path)
    kept = saved.report("batch_id")
    recount = evaluate.confusion(saved.read(), "is_fraud", by=["batch_id"]).select("batch_id", *(F.col(c).alias(f"re_{c}") for c in CELLS))
    told = read_progress(spark, progress).select("batch_id", F.col("n_rows").alias("told_rows"), "duration_ms")
    differs = ~F.col("n_rows").eqNullSafe(F.col("told_rows")) | ~F.coalesce(F.col("duration_ms") > 0, F.lit(False))
    for c in CELLS:
        # A batch without rows has counts in its commit and no group in the recount.
        differs = differs | ~F.col(c).eqNullSafe(F.coalesce(f"re_{c}", F.lit(0)))
    return kept.join(recount, "batch_id", "full").join(told, "batch_id", "full").agg(F.sum("n_rows").alias("n_rows"), F.count_if(differs).alias("n_off"))


def stream_model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second version is published while a stream runs: every row is scored by the version that it names."""
    at, path = scratch_path(spark, "models"), scratch_path(spark, "saved")
    fitted = {"000001": _fitted(spark, sf_dir, "gbt")[0], "000002": _fitted(spark, sf_dir, "lr")[0]}
    stream, sent = _message_stream(spark, fixtures.payloads(spark, sf_dir), files_per_batch=1)
    stream = decode(stream, keep=["offset"])
    registry.publish(fitted["000001"], at, stream.schema)
    live = registry.CurrentModel(at)
    before: list[int] = []  # the batch after which the second version is there: the first that has rows

    def switch(batch_id: int, measures: dict) -> None:
        if not before:
            before.append(batch_id)
            registry.publish(fitted["000002"], at, stream.schema)

    query = score_stream(
        stream, live, path, scratch_path(spark, "checkpoint"), mode="saved", keep=["offset"], on_batch=switch, trigger={"availableNow": True}
    )
    run_to_end(query)
    saved = SavedPredictions(spark, path).read("offset long")
    parts = [_as_in_batch(saved.filter(F.col("model_version") == version), sent, model) for version, model in fitted.items()]
    rows = parts[0].unionByName(parts[1])
    right = F.col("model_version") == F.when(F.col("batch_id") <= max(before, default=-1), "000001").otherwise("000002")
    return rows.select(F.col("offset").alias("transaction_id"), F.col("same").alias("has_score"), right.alias("has_version"), F.lit(live.n_loads <= 2).alias("few_loads"))


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty latest transactions."""
    shown = fixtures.payload_rows(spark, sf_dir)
    return files.preview(shown, order_by=[F.desc("timestamp"), F.desc("transaction_id")])


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        prep_calendar,
        prep_mixed_timestamps,
        prep_timestamp_forms,
        prep_drop_columns,
        csv_roundtrip,
        csv_cell_quality,
        csv_inferred_types,
        class_counts,
        class_weights,
        class_weights_by_split,
        weighted_class_totals,
        document_class_weights,
        hash_split,
        random_split,
        index_labels,
        index_apply,
        index_many_categories,
        onehot_slots,
        feature_slots,
        confusion_matrix,
        classification_metrics,
        metrics_by_type,
        metric_report,
        batch_accuracy,
        train_eval_documents,
        holdout_totals,
        lr_probability_identity,
        gbt_margin_identity,
        probability_simplex,
        model_roundtrip,
        json_roundtrip,
        json_decode_dirty,
        stream_decode,
        stream_score_rows,
        stream_native_rows,
        saved_predictions_view,
        saved_predictions_accuracy,
        saved_predictions_packed,
        saved_predictions_report,
        stream_model_versions,
        preview_rows,
    )
} | {
    f"train_eval_{spec.name}": partial(train_eval, spec=spec) for spec in models.SPECS.values()
}
