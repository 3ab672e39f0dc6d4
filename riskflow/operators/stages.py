"""Pipeline stages of the library's own: they fit, transform, save and load like MLlib's.

All their settings are parameters, so a saved `PipelineModel` holds them, also what a fit has found.
"""

import json
from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators import boosting


def _param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toString)


class FillDefaults(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds columns that are absent, with their default, and marks rows of which a column is a default.

    `defaults` is a JSON object of column and number. Nulls in columns that are there stay, unless `fillNulls` is "true"; those
    of a column in `zeros` (a JSON list) become 0, which isn't a default. The mark is 1 or 0, in `Imputed`; an input column of
    that name is replaced.
    """

    defaults = _param("defaults", "JSON object: column and value")
    zeros = _param("zeros", "JSON list: columns in which a null means 0")
    fillNulls = _param("fillNulls", "true or false: nulls get the default as well")

    @keyword_only
    def __init__(self, *, defaults: str = "{}", zeros: str = "[]", fillNulls: str = "false"):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, defaults: dict[str, float], zeros: tuple[str, ...] = (), fill_nulls: bool = False) -> "FillDefaults":
        return cls(defaults=json.dumps(defaults), zeros=json.dumps(zeros), fillNulls="true" if fill_nulls else "false")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = {c: F.lit(v) for c, v in json.loads(self.getOrDefault("defaults")).items()}
        zeros = set(json.loads(self.getOrDefault("zeros")))
        fill = self.getOrDefault("fillNulls") == "true"
        columns: dict[str, Column] = {}
        imputed = F.lit(0)
        for c, value in values.items():
            if c not in dataset.columns:
                columns[c] = value
                imputed = F.lit(1)
            elif c in zeros:
                columns[c] = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            elif fill:
                columns[c] = F.coalesce(F.col(c), value)
                imputed = F.greatest(imputed, F.col(c).isNull().cast("int"))
        return dataset.withColumns({"Imputed": imputed, **columns})


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds `probability` (a vector), and `prediction`; both are null for a row without one of the features."""

    model = _param("model", "JSON of the fitted trees")

    @keyword_only
    def __init__(self, *, model: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def fitted(self) -> boosting.BoostedModel:
        return boosting.from_json(self.getOrDefault("model"))

    def getInputCols(self) -> list[str]:  # noqa: N802
        return self.fitted().features

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = F.col("__p")
        scored = dataset.withColumn("__p", boosting.probability(self.fitted()))
        vector = F.when(p.isNotNull(), array_to_vector(F.array(1 - F.coalesce(p, F.lit(0.0)), F.coalesce(p, F.lit(0.0)))))
        return scored.withColumns({"probability": vector, "prediction": (p >= 0.5).cast("double")}).drop("__p")


class BoostedTrees(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """The second-order booster as an estimator over numeric columns and `label`."""

    features = _param("features", "JSON list of columns")
    booster = _param("booster", "JSON object: fields of boosting.Booster")
    weightCol = _param("weightCol", "column of row weights, empty for none")

    @keyword_only
    def __init__(self, *, features: str = "[]", booster: str = "{}", weightCol: str = ""):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, features: list[str], booster: boosting.Booster, weight: str | None = None) -> "BoostedTrees":
        return cls(features=json.dumps(features), booster=json.dumps(asdict(booster)), weightCol=weight or "")

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        booster = boosting.Booster(**json.loads(self.getOrDefault("booster")))
        features = json.loads(self.getOrDefault("features"))
        fitted = boosting.fit(dataset, features, booster, self.getOrDefault("weightCol") or None)
        return BoostedTreesModel(model=boosting.to_json(fitted))
