"""CSV transactions and saved predictions."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.functions import parse_timestamp
from txrisk.schema import CSV_TYPES, SCORED
from txrisk.storage import read_text, write_text

# Timestamps keep their microseconds; Spark's own default stops at milliseconds.
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# A quote inside a quoted value is doubled, as most tools write it.
CSV_FORM = {"header": "true", "escape": '"'}


class UnreadableCells(ValueError):
    """Cells whose text does not fit the type of their column."""


class CellQuality:
    """Counts, by column, the cells whose text does not fit; filled by the first job that reads the frame.

    Blank text is a missing value and fits every type.
    """

    def __init__(self) -> None:
        self._observed = Observation()
        self.columns: list[str] = []

    def watch(self, frame: DataFrame, bad: Mapping[str, Column]) -> DataFrame:
        self.columns = list(bad)
        counts = [F.count_if(c).alias(f"bad_{i}") for i, c in enumerate(bad.values())]
        any_bad = reduce(Column.__or__, bad.values(), F.lit(False))
        return frame.observe(self._observed, F.count(F.lit(1)).alias("n_rows"), F.count_if(any_bad).alias("n_bad_rows"), *counts)

    @property
    def n_rows(self) -> int:
        return self._observed.get["n_rows"]

    @property
    def n_bad_rows(self) -> int:
        return self._observed.get["n_bad_rows"]

    @property
    def n_bad(self) -> dict[str, int]:
        """Unreadable cells of every typed column."""
        found = self._observed.get
        return {name: found[f"bad_{i}"] for i, name in enumerate(self.columns)}

    def check(self) -> None:
        """Refuse a table with unreadable cells."""
        found = {name: n for name, n in self.n_bad.items() if n}
        if found:
            listed = ", ".join(f"{name}: {n}" for name, n in found.items())
            raise UnreadableCells(f"{self.n_bad_rows} of {self.n_rows} rows have cells that do not fit ({listed})")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    types: Mapping[str, T.DataType],
    options: Mapping[str, str] | None = None,
    *,
    quality: CellQuality | None = None,
    unreadable: str | None = None,
) -> DataFrame:
    """CSV with a header, typed by column name without an inference pass over the data.

    Only the header line is read to learn the column order. Columns without an entry in
    ``types`` are kept as text. Values are read leniently, as other tools write them:
    ``9.0`` in an integer column that has gaps, ``True`` or ``1`` for a boolean, any ISO
    form of a timestamp. What does not fit its type becomes null.

    ``quality`` counts those cells by column in whatever job reads the frame first; all typed columns are then parsed,
    used or not. ``unreadable`` names a further column with the texts that did not fit, as a JSON object, null for rows
    without any: filter by it to put such rows aside.
    """
    options = {**CSV_FORM, **(options or {})}
    names = spark.read.options(**options).csv(path).columns
    wanted = {name: types.get(name, T.StringType()) for name in names}
    watched = quality is not None or unreadable is not None
    scanned = T.StructType(
        [
            T.StructField(name, t if isinstance(t, T.DoubleType) and not watched else T.StringType())
            for name, t in wanted.items()
        ]
    )
    # Files whose header differs from the first are refused, not read by position.
    frame = spark.read.schema(scanned).options(enforceSchema=False, **options).csv(path)
    typed = [_as_wanted(name, t, scanned[name].dataType).alias(name) for name, t in wanted.items()]
    if not watched:
        return frame.select(typed)
    texts = {name: f"__text_{i}" for i, (name, t) in enumerate(wanted.items()) if not isinstance(t, T.StringType)}
    bad = {name: F.col(f"`{name}`").isNull() & (F.trim(F.col(text)) != "") for name, text in texts.items()}
    frame = frame.select(*typed, *(F.col(f"`{name}`").alias(text) for name, text in texts.items()))
    if quality is not None:
        frame = quality.watch(frame, bad)
    if unreadable is not None:
        found = F.to_json(F.struct(*(F.when(bad[name], F.col(text)).alias(name) for name, text in texts.items())))
        frame = frame.withColumn(unreadable, F.when(found != "{}", found))
    return frame.drop(*texts.values())


def _as_wanted(name: str, wanted: T.DataType, scanned: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(wanted, (T.IntegerType, T.LongType)):
        number = column.try_cast("double")
        whole = F.when(number == F.floor(number), number).try_cast(wanted)
        # Above 2**53 a double no longer holds every whole number.
        return F.coalesce(column.try_cast(wanted), whole) if isinstance(wanted, T.LongType) else whole
    if isinstance(wanted, T.TimestampNTZType):
        return parse_timestamp(column, strict=False)
    if isinstance(wanted, T.StringType) or wanted == scanned:
        return column
    return column.try_cast(wanted)


# The types that a column may turn out to have, narrowest first, with the form of their texts.
_FORMS: tuple[tuple[T.DataType, str | None], ...] = (
    (T.BooleanType(), r"^(?i)(true|false)$"),
    (T.IntegerType(), r"^[+-]?\d+$"),
    (T.LongType(), r"^[+-]?\d+$"),
    (T.DoubleType(), r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"),
    (T.DateType(), r"^\d{4}-\d{1,2}-\d{1,2}$"),
    (T.TimestampNTZType(), None),
)


# Types that read every text of a narrower one as well, narrowest first: whole numbers and numbers, dates and times.
_CHAINS = ((0,), (1, 2, 3), (4, 5))
_FIRST_ROWS = 1_000  # rows that rule types out before the file is read as a whole


def _met(frame: DataFrame, left: Sequence[int]) -> list[int | None]:
    """For every column the types, as bits out of ``left``, that all its values fit, null without values; one aggregate.

    A value that fits a type fits the wider ones of its chain, which are not tried then.
    """
    meets = []
    for i, name in enumerate(frame.columns):
        text, fits = F.trim(F.col(f"`{name}`")), F.lit(0)
        for chain in _CHAINS:
            held, found = F.lit(0), 0
            for bit in reversed([bit for bit in chain if left[i] >> bit & 1]):
                kind, form = _FORMS[bit]
                known = parse_timestamp(text, strict=False).isNotNull() if form is None else text.rlike(form) & text.try_cast(kind).isNotNull()
                found |= 1 << bit
                held = F.when(known, found).otherwise(held)
            fits = fits + held
        meets.append(F.bit_and(F.when(text != "", fits) if left[i] else F.lit(0)).alias(f"c{i}"))
    return list(frame.agg(*meets).first())


def infer_types(spark: SparkSession, path: str | list[str], options: Mapping[str, str] | None = None) -> dict[str, T.DataType]:
    """The narrowest type that every value of a column fits: boolean, int, long, double, date, timestamp, else text.

    One aggregate over the file: each value stands for the set of types that it fits, as bits, and sets are intersected. So the
    answer does not depend on order, partitions or a sample. Types that some of the first rows do not fit are ruled out before and
    not tried on the others; whichever rows these are, the intersection is the same. Blank cells say nothing; a column of blanks is text.
    """
    options = {**CSV_FORM, **(options or {})}
    names = spark.read.options(**options).csv(path).columns
    frame = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).options(enforceSchema=False, **options).csv(path)
    every = [(1 << len(_FORMS)) - 1] * len(names)
    left = [all_ if met is None else met for all_, met in zip(every, _met(frame.limit(_FIRST_ROWS), every))]
    found = _met(frame, left)
    return {name: next((kind for bit, (kind, _) in enumerate(_FORMS) if (found[i] or 0) >> bit & 1), T.StringType()) for i, name in enumerate(names)}


def save_types(spark: SparkSession, path: str, types: Mapping[str, T.DataType]) -> None:
    """Keep the types of a CSV folder beside its files, where readers of the files do not see them."""
    write_text(spark, f"{path.rstrip('/')}/_types.json", json.dumps({name: kind.simpleString() for name, kind in types.items()}))


def load_types(spark: SparkSession, path: str) -> dict[str, T.DataType] | None:
    """The kept types of a CSV folder, null if there are none."""
    held = read_text(spark, f"{path.rstrip('/')}/_types.json")
    return None if held is None else {name: T._parse_datatype_string(kind) for name, kind in json.loads(held).items()}


def read_raw(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Raw transactions; the timestamp stays text for :func:`txrisk.operators.prep.prepare`."""
    return read_csv(spark, path, {**CSV_TYPES, "timestamp": T.StringType()}, options)


def read_transactions(
    spark: SparkSession, path: str | list[str], *, types: Mapping[str, T.DataType] | None = None, quality: CellQuality | None = None, unreadable: str | None = None, **options: str
) -> DataFrame:
    """Prepared transactions; ``types`` adds to the known types of transaction columns, see :func:`read_csv` for the others."""
    return read_csv(spark, path, {**(types or {}), **CSV_TYPES}, options, quality=quality, unreadable=unreadable)


def write_prepared(df: DataFrame, path: str, mode: str = "overwrite", line_breaks: str = "refuse") -> None:
    """Prepared transactions as CSV with a header line per file and no index column.

    A text with a line break fails the job, since readers would take it for two rows unless told ``multiLine``; with
    ``line_breaks="keep"`` it is written as it is, with ``"blank"`` a blank takes the place of each.
    """
    if line_breaks not in ("refuse", "keep", "blank"):
        raise ValueError("line_breaks is 'refuse', 'keep' or 'blank'")
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)] if line_breaks != "keep" else []
    for name in texts:
        text = F.col(f"`{name}`")
        broken = text.contains("\n") | text.contains("\r")
        instead = F.translate(text, "\r\n", "  ") if line_breaks == "blank" else F.raise_error(F.lit(f"a text of {name} has a line break")).cast("string")
        df = df.withColumn(name, F.when(broken, instead).otherwise(text))
    df.write.mode(mode).options(timestampNTZFormat=CSV_TIMESTAMP, **CSV_FORM).csv(path)


def read_predictions(spark: SparkSession, path: str, keep: str = "") -> DataFrame:
    """Saved predictions, with run and batch as prunable partition columns.

    ``keep`` names the columns that were kept beside the usual ones, with types: ``"offset long"``.
    """
    kept = T.StructType.fromDDL(keep) if keep else T.StructType()
    return spark.read.schema(T.StructType([*kept.fields, *SCORED.fields])).parquet(path)


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The first ``n`` rows; with ``order_by``, the same rows every time."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
