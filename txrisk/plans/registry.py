"""Saving and loading fitted pipelines, plain or as numbered versions with a contract."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from txrisk.operators.features import TRANSACTION_FEATURES, FeatureSpec
from txrisk.storage import names, read_text, write_text


def save(model: PipelineModel, path: str) -> None:
    """Write a fitted pipeline, replacing what is at ``path``."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """Read a fitted pipeline."""
    return PipelineModel.load(path)


def publish(model: PipelineModel, path: str, schema: T.StructType, inputs: FeatureSpec = TRANSACTION_FEATURES) -> str:
    """Save a model as the next version below ``path``, then make it the current one; returns the version.

    ``schema`` is that of the rows it was fitted on: the names and types of its inputs become the version's
    contract. Versions are never changed. The pointer to the current one is replaced in one step, so that
    readers see the old version or the new one, complete.
    """
    spark = SparkSession.active()
    path = path.rstrip("/")
    taken = [int(name) for name, _ in names(spark, f"{path}/versions/*") if name.isdigit()]
    version = f"{max(taken, default=0) + 1:06d}"
    contract = {name: schema[name].dataType.simpleString() for name in inputs.inputs}
    model.write().save(f"{path}/versions/{version}/model")  # fails if someone else has taken the number
    write_text(spark, f"{path}/versions/{version}/contract.json", json.dumps(contract, sort_keys=True))
    use(path, version)
    return version


def use(path: str, version: str) -> None:
    """Make a version that exists the current one, an earlier one for instance."""
    spark = SparkSession.active()
    if read_text(spark, f"{path.rstrip('/')}/versions/{version}/contract.json") is None:
        raise ValueError(f"no version {version} below {path}")
    write_text(spark, f"{path.rstrip('/')}/CURRENT", version)


def current(path: str) -> str:
    """The current version."""
    version = read_text(SparkSession.active(), f"{path.rstrip('/')}/CURRENT")
    if version is None:
        raise ValueError(f"no model has been published below {path}")
    return version.strip()


def contract(path: str, version: str) -> dict[str, str]:
    """Names and types of the columns that a version reads."""
    return json.loads(read_text(SparkSession.active(), f"{path.rstrip('/')}/versions/{version}/contract.json") or "{}")


def check_contract(expected: dict[str, str], schema: T.StructType) -> None:
    """Refuse rows whose columns a model was not fitted on. Numbers may be of any numeric type."""
    found = {f.name: f.dataType for f in schema}
    wrong = []
    for name, kind in expected.items():
        if name not in found:
            wrong.append(f"{name} is missing")
        elif found[name].simpleString() != kind and not (isinstance(found[name], T.NumericType) and isinstance(T._parse_datatype_string(kind), T.NumericType)):
            wrong.append(f"{name} is {found[name].simpleString()}, not {kind}")
    if wrong:
        raise ValueError("rows do not fit the model: " + "; ".join(wrong))


@dataclass
class CurrentModel:
    """The current version of a published model, asked for in every batch and loaded only when it has changed.

    Rows are checked against the contract when a version is first used. A version that does not fit is refused, which
    stops the stream; ``use`` of an earlier version and a restart go on.
    """

    path: str
    version: str | None = None
    n_loads: int = 0
    _model: PipelineModel | None = field(default=None, repr=False)

    def __call__(self, schema: T.StructType | None = None) -> PipelineModel:
        version = current(self.path)
        if version != self.version:
            if schema is not None:
                check_contract(contract(self.path, version), schema)
            self._model = load(f"{self.path.rstrip('/')}/versions/{version}/model")
            self.version = version
            self.n_loads += 1
        return self._model
