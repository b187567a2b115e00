"""Classifier evaluation (E1-E6, M10) from a (label, prediction, probability) table.

Everything is computed from the K x K count table (one ``groupBy`` with map-side
combining), so the work over predictions is a single aggregation whatever their number;
ROC / PR / calibration use a score histogram and cumulative sums over bins, or (``exact_curve``)
two-level prefix sums over the distinct scores, never one window over all predictions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import scratch_path
from revlens.sources.registry import new_run_id


def argmax(arr: Column) -> Column:
    """0-based index of the largest element (first on ties)."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def softmax(arr: Column) -> Column:
    m = F.array_max(arr)
    e = F.transform(arr, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_ovr(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class tn, fp, fn, tp (classes = labels and predictions seen)."""
    c = confusion_counts(df, label, pred)
    as_label = c.select(
        F.col("label").alias("class"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"),
        F.lit(0).cast("bigint").alias("fp"),
        F.when(F.col("label") != F.col("prediction"), F.col("n")).otherwise(0).alias("fn"),
    )
    as_pred = c.where(F.col("label") != F.col("prediction")).select(
        F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("fp"), F.lit(0).cast("bigint").alias("fn")
    )
    per = as_label.unionByName(as_pred).groupBy("class").agg(
        F.sum("tp").cast("bigint").alias("tp"), F.sum("fp").cast("bigint").alias("fp"), F.sum("fn").cast("bigint").alias("fn")
    )
    total = c.agg(F.sum("n")).scalar()  # scalar subquery over the K*K counts
    return per.withColumn("tn", (total - F.col("tp") - F.col("fp") - F.col("fn")).cast("bigint")).select(
        "class", "tn", "fp", "fn", "tp"
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def per_class_metrics(ovr: DataFrame) -> DataFrame:
    p = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return ovr.select(
        "class",
        p.alias("precision"),
        r.alias("recall"),
        _ratio(2 * p * r, p + r).alias("f1"),
        (F.col("tp") + F.col("fn")).cast("bigint").alias("support"),
    )


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision / recall / F1 / support plus accuracy, macro and weighted
    averages. Rows are keyed by ``row`` (class id as text, or the summary name)."""
    m = per_class_metrics(confusion_ovr(df, label, pred))
    cls = m.select(F.col("class").cast("string").alias("row"), "precision", "recall", "f1", "support")
    n = F.sum("support")
    summary = m.agg(
        (F.sum(F.col("support") * (F.col("recall"))) / n).alias("accuracy"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / n).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / n).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("wf"),
        n.cast("bigint").alias("n"),
    )
    rows = summary.select(
        F.explode(
            F.array(
                F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"), F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1"), F.col("n").alias("support")),
                F.struct(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"), F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support")),
                F.struct(F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"), F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support")),
            )
        ).alias("s")
    ).select("s.*")
    return cls.unionByName(rows)


def macro_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy and macro F1 / precision / recall in one row."""
    m = per_class_metrics(confusion_ovr(df, label, pred))
    return m.agg(
        (F.sum(F.col("support") * F.col("recall")) / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """K x K counts including zero cells (classes = labels and predictions seen)."""
    c = confusion_counts(df, label, pred)
    classes = c.select(F.array_union(F.collect_set("label"), F.collect_set("prediction")).alias("k"))
    grid = classes.select(F.explode("k").alias("label"), "k").select("label", F.explode("k").alias("prediction"))
    return grid.join(c, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")
    )


def _class_scores(df: DataFrame, label: str, prob: str) -> DataFrame:
    """One row per (prediction row, class) with that class's score and whether it is true."""
    return df.select(F.col(label).alias("__y"), F.posexplode(prob).alias("class", "score")).select(
        "class", "score", (F.col("__y") == F.col("class")).alias("pos")
    )


def score_histogram(df: DataFrame, label: str, prob: str, bins: int = 100) -> DataFrame:
    s = _class_scores(df, label, prob)
    b = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return s.groupBy("class", b.alias("bin")).agg(
        F.sum(F.col("pos").cast("int")).cast("bigint").alias("n_pos"),
        F.sum((~F.col("pos")).cast("int")).cast("bigint").alias("n_neg"),
    )


def roc_pr_points(df: DataFrame, label: str = "label", prob: str = "probability", bins: int = 100) -> DataFrame:
    """E5: one-vs-rest ROC and PR points per class at thresholds ``bin / bins`` (score >=
    threshold counts as positive). Cumulative sums run over <= bins rows per class."""
    h = score_histogram(df, label, prob, bins)
    down = Window.partitionBy("class").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy("class")
    c = h.select(
        "class", "bin",
        F.sum("n_pos").over(down).alias("tp"), F.sum("n_neg").over(down).alias("fp"),
        F.sum("n_pos").over(everything).alias("P"), F.sum("n_neg").over(everything).alias("N"),
    )
    return c.select(
        "class",
        (F.col("bin") / F.lit(float(bins))).alias("threshold"),
        _ratio(F.col("tp"), F.col("P")).alias("tpr"),
        _ratio(F.col("fp"), F.col("N")).alias("fpr"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def exact_curve(df: DataFrame, label: str = "label", prob: str = "probability", parts: int | None = None) -> DataFrame:
    """E5: one-vs-rest ROC and PR points per class at every distinct score; equal scores are one point.

    Two-level prefix sums: the distinct (class, score) rows are range-partitioned, downwards by score, and
    written with their partition's number; the partitions' totals, one row each, give the offsets, and the
    running sums stay within a partition. A class of any size is spread over all partitions. Columns:
    class, threshold, n_pos, n_neg, tp, fp, pos, neg, tpr, fpr, precision. Null labels and scores are left out.
    """
    spark = df.sparkSession
    scores = _class_scores(df.where(F.col(label).isNotNull()), label, prob).where(F.col("score").isNotNull())
    points = scores.groupBy("class", "score").agg(
        F.sum(F.col("pos").cast("bigint")).alias("n_pos"), F.sum((~F.col("pos")).cast("bigint")).alias("n_neg")
    )
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = points.repartitionByRange(n, F.asc("class"), F.desc("score")).withColumn("part", F.spark_partition_id())
    path = scratch_path(spark, f"curve-{new_run_id()}")
    ranged.write.parquet(path)
    held = spark.read.schema(ranged.schema).parquet(path)
    totals = held.groupBy("class", "part").agg(F.sum("n_pos").alias("p"), F.sum("n_neg").alias("n"))
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("class")
    zero = F.lit(0).cast("bigint")
    offsets = totals.select(
        "class", "part", F.coalesce(F.sum("p").over(before), zero).alias("p0"), F.coalesce(F.sum("n").over(before), zero).alias("n0"),
        F.sum("p").over(everything).alias("pos"), F.sum("n").over(everything).alias("neg"),
    )
    down = Window.partitionBy("class", "part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    c = held.join(offsets, ["class", "part"]).select(
        "class", F.col("score").alias("threshold"), "n_pos", "n_neg",
        (F.col("p0") + F.sum("n_pos").over(down)).alias("tp"), (F.col("n0") + F.sum("n_neg").over(down)).alias("fp"), "pos", "neg",
    )
    return c.select(
        "*", _ratio(F.col("tp"), F.col("pos")).alias("tpr"), _ratio(F.col("fp"), F.col("neg")).alias("fpr"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def curve_areas(curve: DataFrame) -> DataFrame:
    """(class, pos, neg, auc, average_precision) of ``exact_curve``: trapezoids under the ROC points, and the
    sum of precision over steps of recall. A class without positives or without negatives has nulls."""
    auc = F.sum(F.col("n_neg") * (F.lit(2) * F.col("tp") - F.col("n_pos"))) / (F.lit(2.0) * F.col("pos") * F.col("neg"))
    ap = F.sum(F.col("n_pos") * F.col("precision")) / F.col("pos")
    both = (F.col("pos") > 0) & (F.col("neg") > 0)
    return curve.groupBy("class", "pos", "neg").agg(F.when(both, auc).alias("auc"), F.when(F.col("pos") > 0, ap).alias("average_precision"))


def calibration(df: DataFrame, label: str = "label", prob: str = "probability", bins: int = 10) -> DataFrame:
    """E5: mean predicted score and observed positive rate per score bin and class."""
    s = _class_scores(df, label, prob)
    b = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return s.groupBy("class", b.alias("bin")).agg(
        F.avg("score").alias("mean_score"), F.avg(F.col("pos").cast("double")).alias("frac_pos"), F.count(F.lit(1)).alias("n")
    )


def cross_entropy(df: DataFrame, label: str = "label", prob: str = "probability", pred: str = "prediction") -> DataFrame:
    """Mean categorical cross-entropy ``-ln p(true class)`` and accuracy."""
    p_true = F.element_at(F.col(prob), F.col(label) + 1)
    return df.agg(
        F.avg(-F.log(p_true)).alias("loss"), F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy")
    )


def one_hot(label: Column, n_classes: int) -> Column:
    """One-hot array<int> of a 0-based class id."""
    return F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda k: F.when(k == label, 1).otherwise(0))


def feature_importance(spark, model, names: list[str] | None = None, top: int | None = None) -> DataFrame:
    """E5: a tree ensemble's ``featureImportances`` as (feature, importance, rank).

    The vector is model state on the driver (one value per feature), not data."""
    vals = model.featureImportances.toArray().tolist()
    rows = [(names[i] if names else str(i), float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    from pyspark.sql import Window as _W

    ranked = df.withColumn("rank", F.row_number().over(_W.orderBy(F.desc("importance"), F.asc("feature"))))
    return ranked.where(F.col("rank") <= top) if top else ranked
