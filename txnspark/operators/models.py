"""Trained models: boosted trees as champion, an isolation forest as challenger."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.functions import scalars as X
from txnspark.operators.sampling import below_threshold, hash_of, stratified_folds
from txnspark.session import written

SEED = 42
#: Values of a feature that a search tells apart, as many as Spark's trees do by themselves (``maxBins``).
BINS = 32
#: Points of one cell, more than the greatest ``minInstancesPerNode`` and for subsampling by parts of a cell.
SHARDS = 16


def weighted(train: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Adds ``weight``: negatives per positive for positives, 1 for negatives."""
    counts = train.agg(
        (F.count_if(F.col(label) == 0) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1))).alias("w")
    )
    return train.withColumn("weight", F.when(F.col(label) == 1, counts.scalar()).otherwise(F.lit(1.0)))


def _boosted_trees(features: Sequence[str], label: str, **params) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    trees = GBTClassifier(labelCol=label, featuresCol="features", weightCol="weight", seed=SEED, **params)
    return Pipeline(stages=[assembler, trees])


def _numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({name: X.finite_or_zero(name) for name in features})


def train_champion(
    train: DataFrame, features: Sequence[str] = S.NUMERIC_FEATURES, label: str = "is_fraud", **params
) -> PipelineModel:
    """Class-weighted boosted trees."""
    return _boosted_trees(features, label, **params).fit(weighted(_numeric(train, features), label))


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """For each feature ascending lower ends of its bins but the first: quantiles, or all values where these are few."""
    fine = df.approxQuantile(list(features), [k / (8 * bins) for k in range(8 * bins + 1)], 1 / (16 * bins))
    edges = []
    for quantiles in fine:
        values = sorted(set(quantiles))
        if len(values) > bins:
            values = [values[k * len(values) // bins] for k in range(bins)]
        edges.append(values[1:])
    return edges


def binned_points(
    train: DataFrame, id_col: str, features: Sequence[str] = S.NUMERIC_FEATURES, label: str = "is_fraud", folds: int = 3
) -> DataFrame:
    """features, label, fold, weight, rows: all rows of ``train`` as weighted points, written once for many fits.

    Trees look at bins of a feature, so they are cut here, over all rows, instead of in every fit. Rows of the same
    bins, label and fold are one cell; a hash of the id deals a cell over ``SHARDS`` points, so
    subsampling takes parts of it, as it does of rows. A point has the summed weight and the number of its rows. However
    many rows there are, the bins bound the points, and where cells hold single rows, points are rows.
    """
    numeric = _numeric(train, features).withColumns({name: F.col(name).cast("double") for name in features})
    parts = stratified_folds(weighted(numeric, label), label, id_col, folds)
    ends = [[-float("inf"), *edges, float("inf")] for edges in bin_edges(numeric, features)]
    # a feature with one value has nothing to cut
    ends = [cuts if len(cuts) > 2 else [cuts[0], 0.0, cuts[-1]] for cuts in ends]
    names = [f"__bin_{name}" for name in features]
    binned = Bucketizer(splitsArray=ends, inputCols=list(features), outputCols=names).transform(parts)
    shard = F.pmod(F.xxhash64(id_col), F.lit(SHARDS)).alias("shard")
    points = binned.groupBy(*names, F.col(label).cast("double").alias(label), "fold", shard).agg(
        F.sum("weight").alias("weight"), F.count("*").cast("double").alias("rows")
    )
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(points)
    return written(vectors.select("features", label, "weight", "rows", "fold"), "points")


def search_champion(
    train: DataFrame,
    id_col: str,
    grid: dict[str, Sequence],
    features: Sequence[str] = S.NUMERIC_FEATURES,
    label: str = "is_fraud",
    folds: int = 3,
) -> CrossValidatorModel:
    """Grid search over stratified folds for the largest area under the precision-recall curve.

    The settings are tried on ``binned_points``; the best is then fitted to the rows.
    """
    pipeline = _boosted_trees(features, label)
    trees = pipeline.getStages()[1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(trees, name), list(values))
    settings = builder.build()
    search = CrossValidator(
        estimator=trees,
        estimatorParamMaps=settings,
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR", weightCol="rows"),
        numFolds=folds,
        foldCol="fold",
        seed=SEED,
    )
    found = search.fit(binned_points(train, id_col, features, label, folds))
    best = pipeline.fit(weighted(_numeric(train, features), label), settings[int(np.argmax(found.avgMetrics))])
    return CrossValidatorModel(best, found.avgMetrics, stdMetrics=found.stdMetrics)


def champion_scores(model: PipelineModel, df: DataFrame, features: Sequence[str] = S.NUMERIC_FEATURES) -> DataFrame:
    """Adds ``probability``, the model's probability of fraud."""
    scored = model.transform(_numeric(df, features))
    return scored.withColumn("probability", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "prediction"
    )


def feature_importance(model: PipelineModel, features: Sequence[str] = S.NUMERIC_FEATURES) -> DataFrame:
    """Features by falling importance."""
    from pyspark.sql import SparkSession

    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(features, weights)]
    table = SparkSession.active().createDataFrame(rows, "feature STRING, importance DOUBLE")
    return table.orderBy(F.col("importance").desc(), "feature")


# Isolation forest -------------------------------------------------------------------------

TREE_SCHEMA = (
    "tree INT, node INT, feature INT, threshold DOUBLE, left_node INT, right_node INT, path DOUBLE"
)


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    length = 2.0 * (np.log(np.maximum(safe - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, length, np.where(n == 2, 1.0, 0.0))


def tree_samples(df: DataFrame, id_col: str, trees: int, rows_per_tree: int) -> DataFrame:
    """``rows_per_tree`` rows for each tree, as (tree, row) pairs.

    A pool of at most ``trees * rows_per_tree`` rows is taken in hash order and each tree reads
    a stretch of it, wrapping around; in large tables the stretches do not overlap. The pool
    is of fixed size whatever the size of the table.
    """
    order, rows = hash_of(id_col, "forest"), trees * rows_per_tree
    pool = below_threshold(df, order, rows).orderBy(order, id_col).limit(rows)
    spots = pool.withColumn("__spot", F.row_number().over(Window.orderBy(hash_of(id_col, "forest"), id_col)) - 1)
    spots = spots.withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy()))
    begin = lambda tree: F.floor(tree * F.col("__rows") / trees)
    member = lambda tree: F.pmod(F.col("__spot") - begin(tree), F.col("__rows")) < rows_per_tree
    chosen = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), member)
    return spots.withColumn("tree", F.explode(chosen)).drop("__spot", "__rows")


def _grow(tree: int, points: np.ndarray) -> list[tuple]:
    rng = np.random.default_rng(SEED * 10_007 + tree)
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list[list] = []

    def add(rows: np.ndarray, depth: int) -> int:
        here = len(nodes)
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(varying) == 0:
            nodes.append([tree, here, -1, 0.0, -1, -1, depth + float(mean_path(len(rows)))])
            return here
        feature = int(rng.choice(varying))
        cut = float(rng.uniform(low[feature], high[feature]))
        nodes.append([tree, here, feature, cut, -1, -1, 0.0])
        goes_left = rows[:, feature] <= cut
        nodes[here][4] = add(rows[goes_left], depth + 1)
        nodes[here][5] = add(rows[~goes_left], depth + 1)
        return here

    add(points, 0)
    return [tuple(node) for node in nodes]


@dataclass(frozen=True)
class IsolationForest:
    """Fitted trees as node rows; ``trees * (2 * rows_per_tree - 1)`` rows at most."""

    nodes: pd.DataFrame
    features: tuple[str, ...]
    rows_per_tree: int

    @classmethod
    def fit(
        cls, df: DataFrame, id_col: str, features: Sequence[str], trees: int = 150, rows_per_tree: int = 256
    ) -> IsolationForest:
        """One Spark group per tree, each on its own small sample; labels are not read."""
        names = list(features)
        numeric = df.select(F.col(id_col), *(X.finite_or_zero(name).alias(name) for name in names))

        def grow(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(id_col)
            rows = _grow(int(group["tree"].iloc[0]), group[names].to_numpy(dtype=float))
            return pd.DataFrame(rows, columns=[f.split()[0] for f in TREE_SCHEMA.split(", ")])

        samples = tree_samples(numeric, id_col, trees, rows_per_tree)
        nodes = samples.groupBy("tree").applyInPandas(grow, TREE_SCHEMA).toPandas()
        used = int(min(rows_per_tree, max(2, numeric.limit(rows_per_tree).count())))
        return cls(nodes.sort_values(["tree", "node"], ignore_index=True), tuple(names), used)

    def score(self, df: DataFrame, out: str = "anomaly") -> DataFrame:
        """Adds the negated anomaly score in [-1, 0]: lower is more unusual."""
        spark = df.sparkSession
        offsets = self.nodes.groupby("tree").size().cumsum().shift(fill_value=0)
        base = self.nodes["tree"].map(offsets).to_numpy()
        table = spark.sparkContext.broadcast(
            {
                "feature": self.nodes["feature"].to_numpy(),
                "threshold": self.nodes["threshold"].to_numpy(),
                "left": self.nodes["left_node"].to_numpy() + base,
                "right": self.nodes["right_node"].to_numpy() + base,
                "path": self.nodes["path"].to_numpy(),
                "roots": offsets.to_numpy(),
                "norm": float(mean_path(self.rows_per_tree)),
            }
        )

        @F.pandas_udf("double")
        def anomaly(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            t = table.value
            for columns in batches:
                points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
                total = np.zeros(len(points))
                everyone = np.arange(len(points))
                for root in t["roots"]:
                    at = np.full(len(points), root)
                    inner = t["feature"][at] >= 0
                    while inner.any():
                        walking = everyone[inner]
                        node = at[walking]
                        left = points[walking, t["feature"][node]] <= t["threshold"][node]
                        at[walking] = np.where(left, t["left"][node], t["right"][node])
                        inner = t["feature"][at] >= 0
                    total += t["path"][at]
                yield pd.Series(-np.power(2.0, -total / len(t["roots"]) / t["norm"]))

        return df.withColumn(out, anomaly(*(X.finite_or_zero(name) for name in self.features)))


def kth_score(df: DataFrame, score: str, k: int, bins: int = 1024) -> float:
    """The ``k``-th smallest score, counted from 1, exactly.

    Each pass counts the scores between two bounds in equal bins and goes on with the least and the greatest
    score of the bin that holds the k-th; only bin counts reach the driver. NULL and NaN scores do not count.
    """
    value = F.col(score).cast("double")
    values = df.select(value.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    low, high = values.agg(F.min("x"), F.max("x")).first()
    below = 0
    while low is not None and low < high:
        here = values.where(F.col("x").between(F.lit(low), F.lit(high)))
        at = F.floor((F.col("x") - F.lit(low)) / F.lit(high - low) * bins).alias("bin")
        rows = here.groupBy(at).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        for row in sorted(rows.collect(), key=lambda r: r.bin):
            if below + row.n >= k:
                low, high = row.low, row.high
                break
            below += row.n
        else:
            return high
    return low


def decision_offset(scored: DataFrame, contamination: float, score: str = "anomaly") -> float:
    """The score below which a share of ``contamination`` of the rows lies, to within one row and ties."""
    n = scored.where(F.col(score).isNotNull()).count()
    return kth_score(scored, score, min(n, round(contamination * n) + 1))


# Importance by effect ---------------------------------------------------------------------


def shuffled_copies(df: DataFrame, id_col: str, features: Sequence[str], repeats: int, digits: int) -> DataFrame:
    """Each row once as it is (copy 0) and, for each feature and repeat, with that feature of another row.

    The other row is the next one by hash within a range of hashes (``digits`` hex digits; 16 to that
    power ranges, to be chosen so that one fits a task); the last takes the first's. Adds
    ``feature``, NULL for copy 0, and ``repeat``.
    """
    names = list(features)
    own = F.struct(*(F.col(name) for name in names))
    moved = df
    for r in range(repeats):
        order = hash_of(id_col, f"shift{r}")
        ranges = Window.partitionBy(F.substring(order, 1, digits)).orderBy(order, id_col)
        first = F.first(own).over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        moved = moved.withColumn(f"__other{r}", F.coalesce(F.lead(own).over(ranges), first))
    none = F.struct(F.lit(None).cast("string").alias("feature"), F.lit(0).alias("repeat"), own.alias("values"))
    copies = [none]
    for r in range(repeats):
        for name in names:
            values = F.struct(*(F.col(f"__other{r}.{n}" if n == name else n).alias(n) for n in names))
            copies.append(F.struct(F.lit(name).alias("feature"), F.lit(r).alias("repeat"), values.alias("values")))
    rest = [c for c in df.columns if c not in names]
    copied = moved.select(*rest, F.inline(F.array(*copies)))
    return copied.select(*rest, "feature", "repeat", "values.*")


def permuted_importance(
    df: DataFrame,
    id_col: str,
    add_probability: Callable[[DataFrame], DataFrame],
    features: Sequence[str] = S.NUMERIC_FEATURES,
    label: str = "is_fraud",
    repeats: int = 3,
    digits: int = 1,
    bins: int = 10_000,
) -> DataFrame:
    """feature, importance, spread: how much average precision falls when a feature comes from another row.

    All copies of a row are scored in one pass and counted by bins of the probability; average
    precision is that of the bins' thresholds. Importance is the mean over the repeats, spread their
    deviation.
    """
    numeric = _numeric(df.select(id_col, label, *features), features)
    scored = add_probability(shuffled_copies(numeric, id_col, features, repeats, digits))
    at = F.floor(F.col("probability") * bins)
    counted = scored.groupBy("feature", "repeat", at.alias("bin")).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos")
    )
    copy = Window.partitionBy("feature", "repeat")
    down = copy.orderBy(F.col("bin").desc())
    precision = F.sum("pos").over(down) / F.sum("n").over(down)
    steps = counted.select("feature", "repeat", (precision * F.col("pos")).alias("step"), "pos")
    quality = steps.groupBy("feature", "repeat").agg(F.try_divide(F.sum("step"), F.sum("pos")).alias("quality"))
    quality = written(quality, "qualities")
    whole = quality.where("feature IS NULL").select("quality").scalar()
    falls = quality.where("feature IS NOT NULL").withColumn("fall", whole - F.col("quality"))
    return falls.groupBy("feature").agg(F.avg("fall").alias("importance"), F.stddev_pop("fall").alias("spread"))
