"""Search for the champion's parameters: density-ratio proposals and successive halving.

Trials come in waves. The first waves are drawn evenly from the space; later ones from where good trials
are dense and others are not (a tree-structured Parzen estimator, each parameter by itself). All
trials of a wave are fitted with few trees on stratified folds; the best part goes on with more
trees, rung by rung. All fits read the folds as weighted points of bounded number, written once
(``models.binned_points``). Where one task can hold the points, a rung is one Spark job with a task for each fit
(``trees``) on points that all tasks share; else every fit is a series of jobs of Spark's boosted trees, several at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.operators import trees as T
from txnspark.operators.models import SEED, binned_points


@dataclass(frozen=True)
class Span:
    """Values from ``low`` to ``high``, evenly or by their logarithm."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def value(self, unit: float) -> float | int:
        if self.whole:
            return int(min(self.high, self.low + math.floor(unit * (self.high - self.low + 1))))
        if self.log:
            return float(self.low * (self.high / self.low) ** unit)
        return float(self.low + unit * (self.high - self.low))


#: What Spark's boosted trees have of the usual parameters; ``positiveWeight`` multiplies the class weight.
SPACE = {
    "maxDepth": Span(3, 10, whole=True),
    "stepSize": Span(0.01, 0.3, log=True),
    "positiveWeight": Span(0.25, 4.0, log=True),
    "subsamplingRate": Span(0.6, 1.0),
    "featureSubset": Span(0.6, 1.0),
    "minInstancesPerNode": Span(1, 10, whole=True),
    "minInfoGain": Span(0.0, 0.05),
}
TRIALS = 40
WAVE = 10
FOLDS = 5
#: Trees at each rung, and the part of the trials that goes on from it.
RUNGS = (50, 150, 450)
GO_ON = 1 / 3
GOOD = 0.25
CANDIDATES = 64
#: Points and cells of points that one task holds; some 24 bytes a point go through the driver, and a fit takes
#: some 40 bytes a point and 200 a cell.
TASK_POINTS = 4_000_000
TASK_CELLS = 1_000_000

TRIAL_SCHEMA = "trial INT, trees INT, {params}, mean_score DOUBLE, score_deviation DOUBLE, is_best BOOLEAN"


def log_density(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log density of ``at`` (rows) under kernels on ``points``, parameter by parameter, with one even kernel."""
    width = max(0.05, 0.5 * len(points) ** -0.2)
    apart = (at[:, None, :] - points[None, :, :]) / width
    kernels = np.exp(-0.5 * apart**2) / (width * math.sqrt(2 * math.pi))
    return np.log((kernels.sum(axis=1) + 1.0) / (len(points) + 1)).sum(axis=1)


def proposals(rng: np.random.Generator, past: Sequence[tuple[np.ndarray, tuple]], size: int, n: int) -> np.ndarray:
    """``n`` points of the unit cube; ``past`` holds points and their ranks, greater is better."""
    if len(past) < WAVE:
        return rng.random((n, size))
    ranked = [point for point, _ in sorted(past, key=lambda trial: trial[1], reverse=True)]
    cut = max(2, math.ceil(GOOD * len(ranked)))
    good, rest = np.array(ranked[:cut]), np.array(ranked[cut:])
    width = max(0.05, 0.5 * len(good) ** -0.2)
    out = []
    for _ in range(n):
        near = good[rng.integers(len(good), size=CANDIDATES)] + rng.normal(0, width, (CANDIDATES, size))
        drawn = np.where((near >= 0) & (near <= 1), near, rng.random((CANDIDATES, size)))
        out.append(drawn[np.argmax(log_density(good, drawn) - log_density(rest, drawn))])
    return np.array(out)


def fold_score(folded: DataFrame, label: str, params: dict, trees: int, fold: int) -> float:
    """Area under the precision-recall curve on ``fold`` of trees fitted to the other folds."""
    given = dict(params)
    factor, subset = given.pop("positiveWeight", 1.0), given.pop("featureSubset", None)
    if subset is not None:
        given["featureSubsetStrategy"] = str(subset)
    weight = F.when(F.col(label) == 1, F.col("weight") * factor).otherwise(F.col("weight"))
    model = GBTClassifier(
        labelCol=label, featuresCol="features", weightCol="weight", seed=SEED, maxIter=trees, **given
    ).fit(folded.where(F.col("fold") != fold).withColumn("weight", weight))
    judged = model.transform(folded.where(F.col("fold") == fold))
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR", weightCol="rows").evaluate(judged)


def scores_by_jobs(folded: DataFrame, label: str, parallel: int) -> Callable[[list[tuple]], list[float]]:
    """Scores of fits (params, trees, fold), each by itself over the cluster."""

    def scores(fits: list[tuple]) -> list[float]:
        score = inheritable_thread_target(folded.sparkSession)(fold_score)
        with ThreadPoolExecutor(parallel) as pool:
            return list(pool.map(lambda fit: score(folded, label, *fit), fits))

    return scores


def shared_cells(folded: DataFrame, features: int, label: str) -> T.Cells:
    """The points of all folds, gathered; the caller has made sure that they are few enough."""
    bins, side = vector_to_array("features"), F.when(F.col(label).isin(0, 1), F.col(label).cast("tinyint")).otherwise(-1)
    columns = [bins[k].cast("tinyint").alias(f"bin{k}") for k in range(features)]
    columns += [side.cast("tinyint").alias("label"), F.col("fold").cast("smallint")]
    points = folded.select(*columns, "weight", "rows").toArrow()
    taken = lambda name: points[name].to_numpy()
    if (taken("label") < 0).any():
        raise ValueError(f"{label} is 0 or 1")
    parts = np.array([taken(f"bin{k}") for k in range(features)])
    return T.Cells.of(parts, taken("label"), taken("weight"), taken("rows"), taken("fold"))


def fits_a_task(folded: DataFrame, label: str, task_points: int) -> bool:
    cells = folded.groupBy(vector_to_array("features"), label).agg(F.count("*").alias("n"))
    found = cells.agg(F.sum("n").alias("points"), F.count("*").alias("cells")).first()
    return (found.points or 0) <= task_points and found.cells <= TASK_CELLS


def scores_in_tasks(folded: DataFrame, features: int, label: str) -> Callable[[list[tuple]], list[float]]:
    """Scores of fits (params, trees, fold), each in a task of its own."""
    spark = folded.sparkSession
    cells = spark.sparkContext.broadcast(shared_cells(folded, features, label))

    def scores(fits: list[tuple]) -> list[float]:
        def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for k in batch["id"]:
                    params, trees, fold = fits[k]
                    score = T.fold_score(cells.value, fold, params, trees, SEED)
                    yield pd.DataFrame({"fit": [k], "score": [score]})

        rows = spark.range(0, len(fits), 1, len(fits)).mapInPandas(fitted, "fit BIGINT, score DOUBLE").collect()
        return [row.score for row in sorted(rows, key=lambda row: row.fit)]

    return scores


def search_trials(
    train: DataFrame,
    id_col: str,
    trials: int = TRIALS,
    rungs: Sequence[int] = RUNGS,
    folds: int = FOLDS,
    wave: int = WAVE,
    space: dict[str, Span] | None = None,
    features: Sequence[str] = S.NUMERIC_FEATURES,
    label: str = "is_fraud",
    parallel: int = 4,
    task_points: int = TASK_POINTS,
) -> DataFrame:
    """One row per trial and rung: parameters, mean and deviation of the score over the folds.

    ``is_best`` marks the row with the greatest mean among those of the last rung. From each rung of a
    wave the best third goes on, at least one. The waves' results decide what is tried next, so the same table and
    arguments give the same trials. Points up to ``task_points`` are fitted in single tasks, more of them by
    ``parallel`` fits at a time over the cluster, as are parameters of Spark's that ``trees`` does not know.
    """
    space = SPACE if space is None else space
    # without the names of the bins, which would make them categories without order
    folded = binned_points(train, id_col, features, label, folds).withMetadata("features", {})
    in_tasks = set(space) <= set(T.DEFAULTS) and fits_a_task(folded, label, task_points)
    scores_of = scores_in_tasks(folded, len(features), label) if in_tasks else scores_by_jobs(folded, label, parallel)
    rng = np.random.default_rng(SEED)
    past: list[tuple[np.ndarray, tuple]] = []
    rows: list[tuple] = []
    while len(past) < trials:
        points = proposals(rng, past, len(space), min(wave, trials - len(past)))
        params = [{n: span.value(u) for (n, span), u in zip(space.items(), point)} for point in points]
        ranks: dict[int, tuple] = {}
        alive = list(range(len(points)))
        for rung, trees in enumerate(rungs):
            found = scores_of([(params[k], trees, fold) for k in alive for fold in range(folds)])
            for k, scores in zip(alive, np.reshape(found, (len(alive), folds))):
                ranks[k] = (rung, float(np.mean(scores)))
                values = [params[k][name] for name in space]
                rows.append((len(past) + k, trees, *values, ranks[k][1], float(np.std(scores))))
            alive = sorted(alive, key=lambda k: (-ranks[k][1], k))[: max(1, math.ceil(len(alive) * GO_ON))]
        past += [(point, ranks[k]) for k, point in enumerate(points)]
    best = max((row for row in rows if row[1] == rungs[-1]), key=lambda row: row[-2])
    kinds = ", ".join(f"{name} {'INT' if span.whole else 'DOUBLE'}" for name, span in space.items())
    table = [(*row, row is best) for row in rows]
    return folded.sparkSession.createDataFrame(table, TRIAL_SCHEMA.format(params=kinds))
