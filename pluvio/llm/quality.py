"""Quality rules: base counts, then robust multivariate outliers per language and source.

Only DataFrame functions are used; no Python runs in tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import WHITE, join_groups, spread, stage

#: The transformed statistics, and the standard deviation that each has at least.
STATISTICS = {"x_word": 0.05, "x_symbol": 0.1, "x_line": 0.05, "x_upper": 0.03, "x_repeat": 0.05}
#: Share of a group's rows that the determinant is minimised over; what makes its covariance consistent
#: for normal data in five dimensions; rows that a language's mean weighs; concentration steps.
KEPT_SHARE, CONSISTENCY, PRIOR_ROWS, STEPS = 0.75, 1.41, 20, 3
#: Squared distance beyond which a vector is rejected: the 1 - 1e-6 quantile of chi-square with 5 degrees.
CUT = 35.9
#: Distances are counted in bins of an eighth of a power of two.
BINS = 8


def document_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the counts of every whole text.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the n_lines
    and n_upper that the method also uses. A null text has none of anything.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    first = docs.select(
        *keep,
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+")).alias("words"),
        lines.alias("lines"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"))
    # windows are told apart by a 64-bit hash of their eight words
    window = F.transform(F.sequence(F.lit(0), F.size("words") - 8),
                         lambda i: F.xxhash64(*(F.get(F.col("words"), i + k) for k in range(8))))
    second = first.select(
        *keep, F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"), "n_upper",
        F.when(F.size("words") > 8, window).alias("windows"))
    sorted_windows = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    third = second.withColumn("windows", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), sorted_windows))
    twin = F.filter("windows", lambda w, j: (w["h"] == F.get(F.col("windows"), j - 1)["h"])
                    | (w["h"] == F.get(F.col("windows"), j + 1)["h"]))
    places = F.array_sort(F.transform(twin, lambda w: w["i"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(places, start, lambda a, i: F.struct(
        (i + 8).alias("end"), (a["n"] + i + 8 - F.greatest(a["end"], i)).alias("n")), lambda a: a["n"])
    return (third.withColumn("n_repeat_words", F.when(F.col("windows").isNull(), F.lit(0).cast("long")).otherwise(covered))
            .drop("windows"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def transformed() -> dict[str, Column]:
    """Bounded or logarithmic statistics; short documents are drawn towards plain prose."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "x_word": F.log((chars + 250) / (n + 50)),
        "x_symbol": F.log1p(20 * F.col("n_symbols") / (n + 20)),
        "x_line": F.col("n_dup_lines") / (F.col("n_lines") + 5),
        "x_upper": F.sqrt(F.col("n_upper") / (chars + 100)),
        "x_repeat": F.col("n_repeat_words") / (n + 20),
    }


def _group_key(lang: Column, source: Column | None) -> Column:
    def part(c):
        return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c))
    return F.concat_ws("\x00", part(lang), *([] if source is None else [part(source)]))


_X = list(STATISTICS)
_PAIRS = [(i, j) for i in range(len(_X)) for j in range(i + 1)]


def _factored(params: DataFrame) -> DataFrame:
    """Add the Cholesky factor l_i_j of the covariance c_i_j, and half the log determinant."""
    for i, j in _PAIRS:
        rest = F.col(f"c_{i}_{j}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        params = params.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l_{j}_{j}"))
    return params.withColumn("logdet", sum((F.log(F.col(f"l_{i}_{i}")) for i in range(len(_X))), F.lit(0.0)))


def _distance(rows: DataFrame) -> DataFrame:
    """Add d2, the squared Mahalanobis distance, by forward substitution."""
    for i, x in enumerate(_X):
        rest = F.col(x) - F.col(f"m_{i}") - sum((F.col(f"l_{i}_{j}") * F.col(f"z_{j}") for j in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"z_{i}", rest / F.col(f"l_{i}_{i}"))
    return rows.withColumn("d2", sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(len(_X))), F.lit(0.0)))


def _moments() -> list[Column]:
    return [F.count("*").cast("double").alias("n"), *(F.sum(x).alias(f"s_{i}") for i, x in enumerate(_X)),
            *(F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"p_{i}_{j}") for i, j in _PAIRS)]


def _estimated(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Means and covariances from sums. The a-priori variances are added in a group of any size: most texts of
    a clean group have the same few zeros, and the spread of these alone would reject a single repeated line."""
    n = F.col("n")
    means = sums.select(*keys, "n", *(F.col(c) for c in sums.columns if c[:2] == "p_"), *(
        (F.col(f"s_{i}") / n).alias(f"m_{i}") for i in range(len(_X))))
    prior = list(STATISTICS.values())
    covariance = [(CONSISTENCY * F.greatest(F.col(f"p_{i}_{j}") / n - F.col(f"m_{i}") * F.col(f"m_{j}"), F.lit(0.0 if i == j else -math.inf))
                   + F.lit(prior[i] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}") for i, j in _PAIRS]
    return _factored(means.select(*keys, "n", *(f"m_{i}" for i in range(len(_X))), *covariance))


def robust_estimates(stats: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimates per language and source: gkey, m_i, l_i_j. ``stats`` is staged.

    Two starts in each group, median with quartile range and plain moments, are
    concentrated STEPS times on the KEPT_SHARE of rows nearest to them; the one
    with the lesser determinant stays. A step is one aggregate of moments per
    group and bin of distance, so a group of any size is summed in all tasks and
    a cut takes whole bins; rows meet their group's estimate where they are. The mean is drawn to the language's own estimate by
    PRIOR_ROWS rows, so that a group of few rows isn't judged by itself alone.
    """
    per = stats.select(*_X, F.explode(F.array(_group_key(F.col("lang"), F.col("source")), F.concat(F.lit("\x01"), _group_key(F.col("lang"), None)))).alias("gkey"))
    grid = 128  # medians are exact over values rounded to this grid, which bounds what is gathered
    quartiles = [F.percentile(F.round(F.col(x) * grid) / grid, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q_{i}")
                 for i, x in enumerate(_X)]
    starts = stage(per.groupBy("gkey").agg(*quartiles, *_moments()))
    sd = [F.greatest((F.col(f"q_{i}")[2] - F.col(f"q_{i}")[0]) / 1.349, F.lit(p)) for i, p in enumerate(STATISTICS.values())]
    middle = _factored(starts.select("gkey", F.lit(0).alias("start"), "n", *(F.col(f"q_{i}")[1].alias(f"m_{i}") for i in range(len(_X))), *(
        (sd[i] * sd[i] if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in _PAIRS)))
    params = stage(middle.unionByName(_estimated(starts.withColumn("start", F.lit(1)), ["gkey", "start"])))
    keys = ["gkey", "start"]
    for _ in range(STEPS):
        far = _distance(join_groups(per, params.drop("n", "logdet", *(f"c_{i}_{j}" for i, j in _PAIRS)), "gkey"))
        binned = (far.withColumn("bin", F.floor(F.log2(F.greatest(F.col("d2"), F.lit(1e-6))) * BINS))
                  .groupBy(*keys, "bin").agg(*_moments()))
        nearer = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        near = (binned.withColumn("nearer", F.coalesce(F.sum("n").over(nearer), F.lit(0.0)))
                .withColumn("rows", F.sum("n").over(Window.partitionBy(*keys)))
                .filter(F.col("nearer") < KEPT_SHARE * F.col("rows")))
        sums = near.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in near.columns if c == "n" or c[:2] in ("s_", "p_")))
        params = stage(_estimated(sums, keys))
    fields = ["n", *(f"m_{i}" for i in range(len(_X))), *(f"l_{i}_{j}" for i, j in _PAIRS)]
    best = stage(params.groupBy("gkey").agg(F.min_by(F.struct(*fields), F.struct("logdet", "start")).alias("p")).select("gkey", "p.*"))
    of_lang = best.filter(F.col("gkey").startswith("\x01")).select(
        F.expr("substring(gkey, 2)").alias("lkey"), *(F.col(f"m_{i}").alias(f"g_{i}") for i in range(len(_X))))
    own = best.filter(~F.col("gkey").startswith("\x01")).withColumn("lkey", F.split("gkey", "\x00")[0])
    drawn = {f"m_{i}": (F.col("n") * F.col(f"m_{i}") + PRIOR_ROWS * F.col(f"g_{i}")) / (F.col("n") + PRIOR_ROWS) for i in range(len(_X))}
    return own.join(of_lang, "lkey").withColumns(drawn).drop("lkey", "n", *(f"g_{i}" for i in range(len(_X))))


def judge_documents(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep``, the counts, base_failed, d2 and kept of every document row.

    kept is false where a base rule fails, else where d2 is beyond CUT. Only
    rows that pass the base rules are estimated over; every row has a distance
    if its group has such a row, and none is kept without one. Null language and
    source are groups; a null or empty text has 0 of everything and fails; rows
    that repeat are judged alike. An empty table gives an empty result.
    """
    rows = spread(docs.select(*dict.fromkeys(["doc_id", "lang", "source", *keep, "text"])))
    counts = document_counts(rows, list(dict.fromkeys(["lang", "source", *keep])))
    stats = stage(counts.withColumn("base_failed", base_failed()).withColumns(transformed()))
    params = stage(robust_estimates(stats.filter(~F.col("base_failed"))))
    judged = _distance(join_groups(stats.withColumn("gkey", _group_key(F.col("lang"), F.col("source"))), params, "gkey", "left"))
    return judged.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "d2",
                         (~F.col("base_failed") & F.coalesce(F.col("d2") <= CUT, F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge_documents`` keeps, unchanged.

    A verdict depends on text, language and source alone, so rejected rows are
    named by their id and a hash of these, and repeated rows go or stay together.
    """
    mark = F.xxhash64(F.coalesce("text", F.lit("")), _group_key(F.col("lang"), F.col("source")))
    keyed = docs.withColumn("_doc", F.coalesce("doc_id", F.lit(0))).withColumn("_mark", mark)
    judged = judge_documents(keyed, ["_doc", "_mark"])
    rejected = stage(judged.filter(~F.col("kept")).select("_doc", "_mark").distinct())
    return keyed.join(rejected, ["_doc", "_mark"], "left_anti").drop("_doc", "_mark")
