"""Fills for missing inputs as a stage of a model: exact median of numbers, most frequent value of text.

The stage casts its inputs itself and is saved with the pipeline it belongs to, so that a loaded
model takes the same raw rows as the fitted one.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatewright.functions import scalars as S
from slatewright.operators.position import median_within


def _finite(name: str):
    """The column as a number; null where it is none, not a number or infinite."""
    value = S.number(name, None)
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


class _Columns(Params):
    numeric = Param(Params._dummy(), "numeric", "columns filled with their median", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "columns filled with their most frequent value", TypeConverters.toListString)

    def outputs(self) -> tuple[list[str], list[str]]:
        return [f"{c}_filled" for c in self.getOrDefault("numeric")], [f"{c}_known" for c in self.getOrDefault("categorical")]


class UsualValues(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Finds the exact median of each number and the most frequent value of each text (of equals the first in order).

    A column without any value gets 0 or ``unknown``. Both are aggregates over (column, value,
    count); the driver sees one row per column.
    """

    @keyword_only
    def __init__(self, numeric=None, categorical=None):
        super().__init__()
        self._setDefault(numeric=[], categorical=[])
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> UsualFill:
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        medians, modes = {}, {}
        if numeric:
            pairs = [F.struct(F.lit(c).alias("c"), _finite(c).alias("v")) for c in numeric]
            tall = dataset.select(F.explode(F.array(*pairs)).alias("p")).select("p.c", "p.v")
            medians = dict(median_within(tall, ["c"], "v").select("c", "median").collect())
        if categorical:
            pairs = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in categorical]
            tall = dataset.select(F.explode(F.array(*pairs)).alias("p")).select("p.c", "p.v").where("v is not null")
            counts = tall.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
            modes = dict(counts.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v")).collect())
        return UsualFill(
            numeric=numeric,
            categorical=categorical,
            medians=[float(medians.get(c, 0.0)) for c in numeric],
            modes=[modes.get(c, "unknown") for c in categorical],
        )


class UsualFill(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Appends ``<name>_filled`` for each number and ``<name>_known`` for each text."""

    medians = Param(Params._dummy(), "medians", "median of each number", TypeConverters.toListFloat)
    modes = Param(Params._dummy(), "modes", "most frequent value of each text", TypeConverters.toListString)

    @keyword_only
    def __init__(self, numeric=None, categorical=None, medians=None, modes=None):
        super().__init__()
        self._setDefault(numeric=[], categorical=[], medians=[], modes=[])
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled, known = self.outputs()
        numbers = zip(filled, self.getOrDefault("numeric"), self.getOrDefault("medians"))
        texts = zip(known, self.getOrDefault("categorical"), self.getOrDefault("modes"))
        return dataset.withColumns({
            **{out: F.coalesce(_finite(c), F.lit(usual)) for out, c, usual in numbers},
            **{out: F.coalesce(F.col(c).cast("string"), F.lit(usual)) for out, c, usual in texts},
        })
