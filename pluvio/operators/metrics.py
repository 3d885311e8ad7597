"""Classifier evaluation as DataFrame aggregates.

Rates come from one confusion aggregate. ROC/PR curves come from per-score
class counts and their cumulative sums; the cumulative sums are computed
per range of the stored counts, as many ranges as the counts ask for, plus a
prefix of the range totals, so no step needs all distinct scores in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b)


# ---------------------------------------------------------------------------
# Confusion-based metrics
# ---------------------------------------------------------------------------

def confusion_cells(pred: DataFrame, labels: Sequence[float] = (0.0, 1.0), label: str = "label",
                    prediction: str = "prediction") -> DataFrame:
    """One row: ``c_i_j`` = rows with label ``labels[i]`` predicted ``labels[j]``.

    ``l_i`` and ``p_j`` count all rows of a label or prediction, ``hits`` those
    that agree and ``n`` all with both, so that pairs outside ``labels`` count.
    """
    y, z = F.col(label), F.col(prediction)
    return pred.filter(y.isNotNull() & z.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y == z).alias("hits"),
        *[F.count_if(y == a).alias(f"l_{i}") for i, a in enumerate(labels)],
        *[F.count_if(z == b).alias(f"p_{j}") for j, b in enumerate(labels)],
        *[F.count_if((y == a) & (z == b)).alias(f"c_{i}_{j}") for i, a in enumerate(labels) for j, b in enumerate(labels)])


def confusion(pred: DataFrame, labels: Sequence[float] = (0.0, 1.0), label: str = "label",
              prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) over the full label grid, zero cells included.

    Pairs outside ``labels``, if there are any, are counted in a row of nulls.
    """
    cells = confusion_cells(pred, labels, label, prediction)
    names = [f"c_{i}_{j}" for i in range(len(labels)) for j in range(len(labels))]
    inside = sum((F.col(c) for c in names), F.lit(0))
    long = cells.select((F.col("n") - inside).alias("outside"), *names).unpivot([], ["outside", *names], "cell", "n")
    lab = F.array(*[F.lit(float(v)) for v in labels])

    def named(place: int) -> Column:
        return F.get(lab, F.get(F.split("cell", "_"), F.lit(place)).cast("int"))

    return (long.filter((F.col("cell") != "outside") | (F.col("n") > 0))
            .select(named(1).alias("label"), named(2).alias("prediction"), "n"))


def _per_label(cells: DataFrame, labels: Sequence[float]) -> tuple[list, Column]:
    total = F.col("n")
    rows = []
    for i, v in enumerate(labels):
        n_i, p_i, tp = F.col(f"l_{i}"), F.col(f"p_{i}"), F.col(f"c_{i}_{i}")
        tpr = _div(tp, n_i)
        fpr = _div(p_i - tp, total - n_i)
        prec = F.coalesce(_div(tp, p_i), F.lit(0.0))
        rec = F.coalesce(tpr, F.lit(0.0))
        f1 = F.coalesce(_div(2 * prec * rec, prec + rec), F.lit(0.0))
        rows.append(dict(label=F.lit(float(v)), n=n_i, share=_div(n_i, total), tpr=tpr, fpr=fpr, precision=prec, f1=f1))
    return rows, total


def error_rate(pred: DataFrame, labels: Sequence[float] = (0.0, 1.0), z: float = 1.96) -> DataFrame:
    """(n, accuracy, error_rate, error_std, ci_low, ci_high)."""
    cells = confusion_cells(pred, labels)
    n = F.col("n")
    acc = _div(F.col("hits"), n)
    err = 1 - acc
    std = F.sqrt(err * (1 - err) / n)
    return cells.select(n.alias("n"), (acc).alias("accuracy"), (err).alias("error_rate"),
                        (std).alias("error_std"), (err - z * std).alias("ci_low"), (err + z * std).alias("ci_high"))


def rates_by_label(pred: DataFrame, labels: Sequence[float] = (0.0, 1.0)) -> DataFrame:
    """(label, n, tpr, fpr, precision, f1) per label."""
    cells = confusion_cells(pred, labels)
    rows, _ = _per_label(cells, labels)
    arr = F.array(*[F.struct(r["label"].alias("label"), r["n"].alias("n"), (r["tpr"]).alias("tpr"),
                             (r["fpr"]).alias("fpr"), (r["precision"]).alias("precision"),
                             (r["f1"]).alias("f1")) for r in rows])
    return cells.select(F.inline(arr))


def weighted_rates(pred: DataFrame, labels: Sequence[float] = (0.0, 1.0)) -> DataFrame:
    """(weighted_tpr, weighted_fpr, weighted_precision, weighted_f1): class-share weighted."""
    cells = confusion_cells(pred, labels)
    rows, _ = _per_label(cells, labels)

    def w(key):
        return sum((F.coalesce(r["share"] * r[key], F.lit(0.0)) for r in rows), F.lit(0.0))

    return cells.select((w("tpr")).alias("weighted_tpr"), (w("fpr")).alias("weighted_fpr"),
                        (w("precision")).alias("weighted_precision"), (w("f1")).alias("weighted_f1"))


def classification_table(pred: DataFrame, labels: Sequence[float] = (0.0, 1.0), z: float = 1.96) -> DataFrame:
    """(metric, value) for E1-E3, E5-E8, E14 from a single confusion aggregate."""
    cells = confusion_cells(pred, labels)
    rows, total = _per_label(cells, labels)
    acc = _div(F.col("hits"), total)
    err = 1 - acc
    std = F.sqrt(err * (1 - err) / total)

    def w(key):
        return sum((F.coalesce(r["share"] * r[key], F.lit(0.0)) for r in rows), F.lit(0.0))

    items = [("n", total), ("accuracy", acc), ("error_rate", err), ("error_std", std),
             ("ci_low", err - z * std), ("ci_high", err + z * std),
             ("weighted_tpr", w("tpr")), ("weighted_fpr", w("fpr")),
             ("weighted_precision", w("precision")), ("weighted_f1", w("f1"))]
    for v, r in zip(labels, rows):
        items += [(f"tpr_{v}", r["tpr"]), (f"fpr_{v}", r["fpr"])]
    arr = F.array(*[F.struct(F.lit(name).alias("metric"), (val.cast("double")).alias("value")) for name, val in items])
    return cells.select(F.inline(arr))


def f1(pred: DataFrame, labels: Sequence[float] = (0.0, 1.0)) -> DataFrame:
    """Weighted F1 (the evaluator's ``f1`` metric)."""
    return weighted_rates(pred, labels).select(F.col("weighted_f1").alias("f1"))


# ---------------------------------------------------------------------------
# Curves
# ---------------------------------------------------------------------------

def score_counts(pred: DataFrame, score: str = "score", label: str = "label", positive: float = 1.0) -> DataFrame:
    """(score, pos, neg): class counts per distinct score (map-side combined)."""
    is_pos = F.col(label) == positive
    return pred.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(is_pos).alias("pos"), F.count_if(~is_pos).alias("neg"))


#: Rows of a range of the distributed prefix sum.
PER_RANGE = 100_000


def descending_prefix(counts: DataFrame, order: str, values: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Adds ``cum_<v>`` = sum of ``v`` over rows with ``order`` >= this row's (desc order, nulls last).

    ``counts`` is stored, so its source is read once; its rows, as many as there
    are different scores, are dealt out by ranges of ``order``, one for PER_RANGE
    rows (or ``buckets``), summed cumulatively inside each range and offset by the ranges before (one
    row each). No window ever holds all scores, however many there are.
    Also adds ``tot_<v>`` (grand totals).
    """
    stored = materialize(counts)
    ranges = buckets or -(-stored.count() // PER_RANGE)
    if ranges <= 1:  # PER_RANGE rows at most, one window
        whole = Window.orderBy(F.col(order).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
        return stored.select("*", *[F.sum(v).over(whole).alias(f"cum_{v}") for v in values], *[F.sum(v).over(Window.partitionBy()).alias(f"tot_{v}") for v in values])
    b = materialize(stored.repartitionByRange(ranges, F.col(order).desc_nulls_last()).withColumn("bucket", F.spark_partition_id()))
    w = Window.partitionBy("bucket").orderBy(F.col(order).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    local = b.select("*", *[F.sum(v).over(w).alias(f"loc_{v}") for v in values])
    totals = b.groupBy("bucket").agg(*[F.sum(v).alias(f"bt_{v}") for v in values])
    wall = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("bucket", *[F.coalesce(F.sum(f"bt_{v}").over(wall), F.lit(0)).alias(f"off_{v}")
                                        for v in values],
                            *[F.sum(f"bt_{v}").over(Window.partitionBy()).alias(f"tot_{v}") for v in values])
    joined = local.join(F.broadcast(offsets), "bucket")
    return joined.select(*counts.columns, *[(F.col(f"loc_{v}") + F.col(f"off_{v}")).alias(f"cum_{v}") for v in values],
                         *[F.col(f"tot_{v}") for v in values])


def curve_points(pred: DataFrame, score: str = "score", label: str = "label", bins: int = 0,
                 positive: float = 1.0) -> DataFrame:
    """(threshold, pos, neg, cum_pos, cum_neg, tot_pos, tot_neg) per curve point.

    With ``bins`` > 0 consecutive distinct scores (in descending order) are
    merged in chunks of floor(distinct/bins) when that is at least 2; the
    point's threshold is the lowest score of its chunk. Chunks are formed
    globally, so the result does not depend on partitioning.
    """
    counts = score_counts(pred, score, label, positive).withColumn("one", F.lit(1))
    cum = descending_prefix(counts, "score", ["pos", "neg", "one"])
    if bins <= 0:
        return cum.select(F.col("score").alias("threshold"), "pos", "neg", "cum_pos", "cum_neg", "tot_pos", "tot_neg")
    grouping = F.floor(F.col("tot_one") / bins)
    chunk = F.when(grouping >= 2, F.floor((F.col("cum_one") - 1) / grouping)).otherwise(F.col("cum_one") - 1)
    return (cum.withColumn("chunk", chunk)
               .groupBy("chunk").agg(F.min("score").alias("threshold"), F.sum("pos").alias("pos"),
                                     F.sum("neg").alias("neg"), F.max("cum_pos").alias("cum_pos"),
                                     F.max("cum_neg").alias("cum_neg"), F.first("tot_pos").alias("tot_pos"),
                                     F.first("tot_neg").alias("tot_neg"))
               .drop("chunk"))


def roc_curve(pred: DataFrame, score: str = "score", label: str = "label", bins: int = 0) -> DataFrame:
    """(threshold, fpr, tpr) per point, plus the (0,0) and (1,1) end points (threshold null)."""
    pts = curve_points(pred, score, label, bins)
    body = pts.select("threshold", (_div(F.col("cum_neg"), F.col("tot_neg"))).alias("fpr"),
                      (_div(F.col("cum_pos"), F.col("tot_pos"))).alias("tpr"))
    ends = pred.sparkSession.createDataFrame([(None, 0.0, 0.0), (None, 1.0, 1.0)], "threshold double, fpr double, tpr double")
    return body.unionByName(ends)


def _roc_area() -> Column:
    return (F.col("neg") / F.col("tot_neg")) * ((2 * F.col("cum_pos") - F.col("pos")) / (2 * F.col("tot_pos")))


def _pr_area() -> Column:
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    prev_tp, prev_fp = F.col("cum_pos") - F.col("pos"), F.col("cum_neg") - F.col("neg")
    prev_prec = F.when(prev_tp + prev_fp == 0, prec).otherwise(prev_tp / (prev_tp + prev_fp))
    return (F.col("pos") / F.col("tot_pos")) * (prec + prev_prec) / 2


def curve_areas(pred: DataFrame, score: str = "score", label: str = "label", bins: int = 0) -> DataFrame:
    """(auc_roc, auc_pr) from one pass over one set of curve points."""
    pts = curve_points(pred, score, label, bins)
    return pts.agg((F.sum(_roc_area())).alias("auc_roc"), (F.sum(_pr_area())).alias("auc_pr"))


def auc_roc(pred: DataFrame, score: str = "score", label: str = "label", bins: int = 0) -> DataFrame:
    """(auc_roc): trapezoid area under (0,0) → points → (1,1).

    Each point contributes Δfpr × mean(tpr before, tpr after); both come
    from the point's own cumulative counts, so the area is a plain sum.
    """
    pts = curve_points(pred, score, label, bins)
    return pts.agg((F.sum(_roc_area())).alias("auc_roc"))


def auc_pr(pred: DataFrame, score: str = "score", label: str = "label", bins: int = 0) -> DataFrame:
    """(auc_pr): trapezoid area under the PR curve started at (0, first precision)."""
    pts = curve_points(pred, score, label, bins)
    return pts.agg((F.sum(_pr_area())).alias("auc_pr"))


def score_label(pred: DataFrame, prob_col: str = "probability", label: str = "label", k: int | None = None) -> DataFrame:
    """(P(class 1), label) of every row, or the ``k`` highest scores as a preview."""
    from pyspark.ml.functions import vector_to_array
    pairs = pred.select(vector_to_array(prob_col)[1].alias("score"), label)
    return pairs if k is None else pairs.orderBy(F.desc("score"), label).limit(k)
