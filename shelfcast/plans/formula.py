"""A fixed formula as a model: a weighted sum of features, published, loaded and scored like any other.

It serves as a baseline that needs no training, and as a model whose predictions have a value that
can be worked out elsewhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Model, Pipeline
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from shelfcast.functions.coerce import require_columns


class FormulaModel(Model, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``intercept + weights[0] * names[0] + ...``, added up from left to right.

    A null in a named column makes the prediction null (the model matrix has none).
    """

    names = Param(Params._dummy(), "names", "columns of the sum", TypeConverters.toListString)
    weights = Param(Params._dummy(), "weights", "one weight for each column", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "the sum's first term", TypeConverters.toFloat)

    def __init__(self, terms=None, intercept=0.0, predictionCol="y_pred_log"):
        super().__init__()
        terms = dict(terms or {})
        self._setDefault(names=[], weights=[], intercept=0.0, predictionCol="y_pred_log")
        self._set(names=list(terms), weights=[float(w) for w in terms.values()], intercept=float(intercept), predictionCol=predictionCol)

    def terms(self):
        return dict(zip(self.getOrDefault("names"), self.getOrDefault("weights"), strict=True))

    def _transform(self, dataset):
        terms = self.terms()
        require_columns(dataset, list(terms))
        parts = [F.lit(w) * F.col(n).cast("double") for n, w in terms.items()]
        total = reduce(lambda a, b: a + b, parts, F.lit(self.getOrDefault("intercept")))
        return dataset.withColumn(self.getPredictionCol(), total)


def formula(terms, intercept=0.0):
    """A learner for ``train``: nothing is fitted, the run's model is the formula."""
    return Pipeline(stages=[FormulaModel(terms, intercept)])
