"""Class balance, confusion counts, precision and recall over thresholds.

A row without a score is flagged at no threshold and counts as such everywhere: as a miss or as a
true negative by its label.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnspark.functions import scalars as X
from txnspark.session import written

SCORE_RANGES = 1000


def class_balance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows per class, share of the positive class, and negatives per positive."""
    positive = F.count_if(F.col(label) == 1)
    negative = F.count_if(F.col(label) == 0)
    return df.agg(negative.alias("negatives"), positive.alias("positives")).select(
        "negatives",
        "positives",
        F.try_divide(F.col("positives").cast("double"), F.col("negatives") + F.col("positives")).alias("fraud_ratio"),
        (F.col("negatives") / F.greatest(F.col("positives"), F.lit(1))).alias("positive_weight"),
    )


def _ratios(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    zero = F.lit(0.0)
    return {
        "precision": F.coalesce(F.try_divide(tp.cast("double"), tp + fp), zero),
        "recall": F.coalesce(F.try_divide(tp.cast("double"), tp + fn), zero),
        "f1": F.coalesce(F.try_divide(tp * F.lit(2.0), tp * 2 + fp + fn), zero),
    }


def confusion(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    """The four cells with precision, recall and F1; undefined ratios are zero.

    A prediction that is NULL, as without a score, is not flagged.
    """
    actual, predicted = F.col(label) == 1, F.coalesce(predicted, F.lit(False))
    return df.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    ).withColumns(_ratios(F.col("tp"), F.col("fp"), F.col("fn")))


def confusion_by_class(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    """Rows per actual and predicted class, with precision, recall and F1 of each class."""
    cells = confusion(df, label, predicted).select("tp", "fp", "fn", "tn")
    both = cells.select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("class"), F.col("tn").alias("hit"), F.col("fn").alias("over"), F.col("fp").alias("miss")),
                F.struct(F.lit(1).alias("class"), F.col("tp").alias("hit"), F.col("fp").alias("over"), F.col("fn").alias("miss")),
            )
        ).alias("c")
    ).select("c.*")
    ratios = _ratios(F.col("hit"), F.col("over"), F.col("miss"))
    return both.select(
        "class",
        (F.col("hit") + F.col("miss")).alias("support"),
        *(value.alias(name) for name, value in ratios.items()),
    )


def precision_recall_curve(df: DataFrame, label: str, score: str, ranges: int = SCORE_RANGES) -> DataFrame:
    """Precision and recall at every distinct score, taken as ``score >= threshold``.

    Rows shrink to one per distinct score first. Those are cut into ``ranges`` of about equal
    size (the cut points are a bounded list of quantiles), counted up within each range, and
    shifted by the totals of the higher ranges; no window spans the whole table. NULL scores are
    no threshold, but their positives count as missed.
    """
    groups = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("__pos"), F.count(F.lit(1)).alias("__all")
    )
    # the cut points need a job of their own; written, so that the groups are made once
    groups = written(groups, "score-groups")
    ranges = max(ranges, 2)
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(groups.approxQuantile("threshold", shares, 1.0 / (2 * ranges))))
    splits = [float("-inf"), *(cuts or [0.0]), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="threshold", outputCol="__range").transform(groups)
    higher = Window.orderBy(F.col("__range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    totals = (
        ranged.groupBy("__range")
        .agg(F.sum("__pos").alias("__p"), F.sum("__all").alias("__a"))
        .select(
            "__range",
            F.coalesce(F.sum("__p").over(higher), F.lit(0)).alias("__p_before"),
            F.coalesce(F.sum("__a").over(higher), F.lit(0)).alias("__a_before"),
            F.sum("__p").over(whole).alias("positives"),
        )
    )
    down = Window.partitionBy("__range").orderBy(F.col("threshold").desc())
    down = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.withColumn("__tp", F.sum("__pos").over(down))
        .withColumn("__predicted", F.sum("__all").over(down))
        .join(F.broadcast(totals), "__range")
        .select(
            "threshold",
            F.col("__pos").alias("positives_here"),
            "positives",
            (F.col("__tp") + F.col("__p_before")).alias("tp"),
            (F.col("__predicted") + F.col("__a_before")).alias("predicted"),
        )
        .withColumn("precision", F.col("tp") / F.col("predicted"))
        .withColumn("recall", F.coalesce(F.try_divide(F.col("tp"), F.col("positives")), F.lit(0.0)))
    )


def average_precision(df: DataFrame, label: str, score: str, ranges: int = SCORE_RANGES) -> DataFrame:
    """Area under the precision-recall curve as a sum of steps, not interpolated."""
    curve = precision_recall_curve(df, label, score, ranges)
    step = F.try_divide(F.col("precision") * F.col("positives_here"), F.col("positives"))
    return curve.agg(F.coalesce(F.sum(step), F.lit(0.0)).alias("average_precision"))


def threshold_sweep(df: DataFrame, label: str, score: str, top: int = 100) -> DataFrame:
    """Precision, recall and F1 of ``score > t`` for t = 0..top.

    A score exceeds exactly the thresholds below its ceiling, so one aggregate into at most
    ``top + 2`` bins serves all thresholds.
    """
    bins = F.least(F.greatest(F.ceil(F.col(score)), F.lit(0)), F.lit(top + 1))
    counted = df.groupBy(bins.alias("__bin")).agg(
        F.count_if(F.col(label) == 1).alias("__pos"), F.count_if(F.col(label) == 0).alias("__neg")
    )
    above = Window.orderBy(F.col("__bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    swept = (
        df.sparkSession.range(top + 2)
        .withColumnRenamed("id", "__bin")
        .join(counted, "__bin", "left")
        .select(
            F.col("__bin").cast("int").alias("threshold"),
            F.coalesce(F.sum("__pos").over(above), F.lit(0)).alias("tp"),
            F.coalesce(F.sum("__neg").over(above), F.lit(0)).alias("fp"),
            F.coalesce(F.sum("__pos").over(whole), F.lit(0)).alias("__positives"),
        )
        .where(F.col("threshold") <= top)
        .withColumn("fn", F.col("__positives") - F.col("tp"))
        .drop("__positives")
    )
    return swept.withColumns(_ratios(F.col("tp"), F.col("fp"), F.col("fn")))


def best_threshold(df: DataFrame, label: str, score: str, top: int = 100) -> DataFrame:
    """The lowest threshold with the highest F1."""
    return threshold_sweep(df, label, score, top).orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1)


def raw_range(df: DataFrame, raw: str) -> DataFrame:
    """Smallest and largest raw score: the stored scale of a challenger."""
    return df.agg(F.min(raw).alias("raw_min"), F.max(raw).alias("raw_max"))


def rescaled_risk(df: DataFrame, raw: str, scale: DataFrame, out: str = "risk_score") -> DataFrame:
    """0-100 risk from raw anomaly scores and a stored one-row scale."""
    low, high = scale.select("raw_min").scalar(), scale.select("raw_max").scalar()
    return df.withColumn(out, X.risk_from_raw(F.col(raw), low, high))


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind.split("(")[0] in NUMERIC_TYPES]


def _value_counts(df: DataFrame) -> DataFrame:
    """column_name, text, n: rows by column and value."""
    cells = [F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").cast("string").alias("text")) for name in df.columns]
    return (
        df.select(F.explode(F.array(*cells)).alias("c"))
        .select("c.*")
        .groupBy("column_name", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def profile(df: DataFrame) -> DataFrame:
    """Per column: non-null rows, distinct values, commonest value, mean, deviation, smallest, largest.

    Rows shrink to one per column and value first, all columns in one shuffle, so no task
    holds the set of distinct values of a column.
    """
    numeric = set(_numeric_columns(df))
    values = _value_counts(df)
    used = F.when(F.col("text").isNotNull(), F.col("n"))
    commonest = F.max(F.when(F.col("text").isNotNull(), F.struct(F.col("n"), F.col("text"))))
    sums = values.groupBy("column_name").agg(
        F.coalesce(F.sum(used), F.lit(0)).alias("non_null"),
        F.count("text").alias("distinct_values"),
        commonest.alias("__top"),
    )
    names = [name for name in df.columns if name in numeric]
    moments = df.agg(
        *(
            F.struct(
                F.lit(name).alias("name"),
                F.avg(value).alias("mean_value"),
                F.stddev_samp(value).alias("deviation"),
                F.min(value).alias("min_number"),
                F.max(value).alias("max_number"),
            ).alias(f"__{k}")
            for k, name in enumerate(names)
            for value in (F.col(name).cast("double"),)
        )
    )
    kind = "array<struct<name:string,mean_value:double,deviation:double,min_number:double,max_number:double>>"
    moments = moments.select(F.inline(F.array(*(f"__{k}" for k in range(len(names)))).cast(kind)))
    # one row for each column of the profiled table
    return sums.join(F.broadcast(moments), F.col("column_name") == F.col("name"), "left").select(
        "column_name",
        "non_null",
        "distinct_values",
        F.col("__top.text").alias("top_value"),
        F.col("__top.n").alias("top_rows"),
        "mean_value",
        "deviation",
        "min_number",
        "max_number",
    )


CANDIDATES = 64
TRACKED = 10_000


def _common_values(df: DataFrame, candidates: dict[str, list[str]]) -> DataFrame:
    """column_name, text, n: rows by column and value, of the listed values alone."""
    cells = []
    for name, values in candidates.items():
        text = F.col(f"`{name}`").cast("string")
        cells.append(F.struct(F.lit(name).alias("column_name"), F.when(text.isin(values), text).alias("text")))
    listed = F.filter(F.array(*cells), lambda c: c["text"].isNotNull())
    counted = df.select(F.explode(listed).alias("c")).select("c.*").groupBy("column_name", "text")
    return counted.agg(F.count(F.lit(1)).alias("n"))


def profile_by_sketches(
    df: DataFrame, candidates: int = CANDIDATES, tracked: int = TRACKED, error: float = 0.02
) -> DataFrame:
    """``profile`` for tables whose distinct values are too many to shuffle; the distinct count is an estimate.

    One scan gives, per column, mergeable sketches of the distinct count (relative deviation ``error``)
    and of the commonest values; a second one counts at most ``candidates`` values of a column. The best of
    these is the commonest value for certain if it has more rows than any value that the sketch left out can have.
    Columns where it has not, such as ids, are counted value by value. So the commonest value, of several the
    largest text, is exact for every column. Both scans run when this is called; the driver gets ``candidates`` values of each
    column. A column without a value has nulls; an empty table gives its columns with zero rows.
    """
    numeric = set(_numeric_columns(df))
    sketches = []
    for name in df.columns:
        col = F.col(f"`{name}`")
        number = col.cast("double") if name in numeric else F.lit(None).cast("double")
        sketches.append(
            F.struct(
                F.count(col).alias("non_null"),
                F.approx_count_distinct(col, error).alias("distinct_estimate"),
                F.expr(f"approx_top_k(CAST(`{name}` AS STRING), {candidates}, {tracked})").alias("top"),
                F.avg(number).alias("mean_value"),
                F.stddev_samp(number).alias("deviation"),
                F.min(number).alias("min_number"),
                F.max(number).alias("max_number"),
            )
        )
    all_rows = F.count(F.lit(1)).alias("rows")
    scan = df.agg(all_rows, F.array(*(s.alias("s") for s in sketches)).alias("columns")).first()
    found = dict(zip(df.columns, scan["columns"]))
    listed = {name: [t["item"] for t in s["top"] if t["item"] is not None] for name, s in found.items()}
    listed = {name: values for name, values in listed.items() if values}
    best: dict[str, tuple[int, str]] = {}
    if listed:
        for r in _common_values(df, listed).collect():
            best[r["column_name"]] = max(best.get(r["column_name"], (0, "")), (r["n"], r["text"]))

    # the sketch loses no value of more than twice its error, which is 3.5 / (tracked / 0.75) of the rows at most
    lost = 2 * 3.5 * 0.75 * scan["rows"] / tracked
    flat, rows = [], []
    for name, s in found.items():
        # a value beyond the last place of a full list has at most the estimate of that place
        beyond = min(t["count"] for t in s["top"]) if len(s["top"]) >= candidates else 0
        n, text = best.get(name, (None, None))
        if s["non_null"] and (n is None or n <= max(lost, beyond)):
            flat.append(name)
            n = text = None
        numbers = (s["mean_value"], s["deviation"], s["min_number"], s["max_number"])
        rows.append((name, s["non_null"], s["distinct_estimate"], text, n, *numbers))
    columns = (
        "column_name string, non_null long, distinct_estimate long, top_value string, top_rows long, "
        "mean_value double, deviation double, min_number double, max_number double"
    )
    result = df.sparkSession.createDataFrame(rows, columns)
    if not flat:
        return result
    counts = _value_counts(df.select(*(f"`{name}`" for name in flat))).where(F.col("text").isNotNull())
    tops = counts.groupBy("column_name").agg(F.max(F.struct("n", "text")).alias("__top"))
    return result.join(tops, "column_name", "left").select(
        "column_name",
        "non_null",
        "distinct_estimate",
        F.coalesce("top_value", "__top.text").alias("top_value"),
        F.coalesce("top_rows", "__top.n").alias("top_rows"),
        "mean_value",
        "deviation",
        "min_number",
        "max_number",
    )


def quartiles(df: DataFrame, accuracy: int = 100_000) -> DataFrame:
    """Quartiles of every numeric column from mergeable sketches, within 1/accuracy of the rank."""
    names = _numeric_columns(df)
    sketch = df.agg(*(F.percentile_approx(n, [0.25, 0.5, 0.75], accuracy).cast("array<double>").alias(n) for n in names))
    rows = F.array(*(F.struct(F.lit(n).alias("column_name"), F.col(n).alias("q")) for n in names))
    return sketch.select(F.explode(rows).alias("r")).select(
        "r.column_name", *(F.col("r.q")[i].alias(f"q{25 * (i + 1)}") for i in range(3))
    )
