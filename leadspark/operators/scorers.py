"""Evaluators for ``pyspark.ml`` tuning, bound to a k."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadspark.operators import metrics as M


class TopKEvaluator(Evaluator):
    """precision, recall or lift among the k best rows, or average precision; larger is better."""

    def __init__(self, metric: str = "precision_at_k", k: int = 1000, target: str = "target", key: str = "row_key", score: str | None = None):
        super().__init__()
        self.metric, self.k, self.target, self.key, self.score = metric, k, target, key, score

    def _evaluate(self, dataset: DataFrame) -> float:
        score = F.col(self.score) if self.score else vector_to_array("probability")[1]
        df = dataset.select(self.key, self.target, score.alias("_p"))
        if self.metric == "average_precision":
            return float(M.average_precision(df, target=self.target, score="_p").first()[0])
        return float(M.at_k(df, self.k, self.target, "_p", self.key).first()[self.metric])

    def isLargerBetter(self) -> bool:
        return True


def precision_at_k_scorer(k: int, **kw) -> TopKEvaluator:
    return TopKEvaluator("precision_at_k", k, **kw)


def recall_at_k_scorer(k: int, **kw) -> TopKEvaluator:
    return TopKEvaluator("recall_at_k", k, **kw)


def lift_at_k_scorer(k: int, **kw) -> TopKEvaluator:
    return TopKEvaluator("lift_at_k", k, **kw)
