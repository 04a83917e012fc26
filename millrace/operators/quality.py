"""Missing values, profiles, completeness gates, key checks and drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from millrace.functions.columns import mean_of, nan_to_null
from millrace.operators.ordered import over_series
from millrace.operators.series import ffill_bfill
from millrace.session import materialize


def unpivot(df: DataFrame, cols: list[str], ids: list[str] | None = None) -> DataFrame:
    """One row per id and column, as (column, value)."""
    typed = df.select(*(ids or []), *[F.col(c).cast("double").alias(c) for c in cols])
    typed = nan_to_null(typed, cols)
    return typed.unpivot([F.col(i) for i in ids or []], [F.col(c) for c in cols],
                         "column", "value")


def missing_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing count and share per column, and for the whole dataset as column `*`; one pass. NaN
    is missing, here and in all figures below."""
    cols = cols or df.columns
    df = nan_to_null(df, cols)
    counts = df.agg(F.count(F.lit(1)).alias("_n"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    total = reduce(lambda a, b: a + b, [F.col(c) for c in cols])
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"),
                        F.col("_n").alias("cells")) for c in cols]
    entries.append(F.struct(F.lit("*").alias("column"), total.alias("missing"),
                            (F.col("_n") * len(cols)).alias("cells")))
    return counts.select(F.inline(F.array(*entries))).withColumn(
        "missing_ratio", F.try_divide(F.col("missing").cast("double"), F.col("cells"))
    )


def profile(df: DataFrame, cols: list[str], *, keys: list[str], order: list[str],
            **limits: int) -> DataFrame:
    """Mean and sample deviation after filling both ways, missing share before it."""
    df = nan_to_null(df, cols)
    marked = df.withColumns({f"_raw_{c}": F.col(c) for c in cols})
    filled = ffill_bfill(marked, cols, keys=keys, order=order, **limits)
    figures = filled.groupBy(*keys).agg(*[
        F.struct(
            mean_of(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.try_divide(F.count_if(F.col(f"_raw_{c}").isNull()).cast("double"),
                         F.count(F.lit(1))).alias("missing_ratio"),
        ).alias(c) for c in cols
    ])
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.mean"), F.col(f"`{c}`.std"),
                        F.col(f"`{c}`.missing_ratio")) for c in cols]
    return figures.select(*keys, F.inline(F.array(*entries)))


def row_metrics(df: DataFrame, key: str, cols: list[str], volume: str = "volume") -> DataFrame:
    """Rows, missing cells and rows with volume per key."""
    df = nan_to_null(df, [*cols, volume])
    missing: Column = reduce(
        lambda a, b: a + b, [F.col(c).isNull().cast("long") for c in cols]
    )
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(missing).alias("missing_values"),
        F.count_if(F.col(volume) > 0).alias("trading_days"),
    )


def completeness_scores(metrics: DataFrame, threshold: float = 0.9, n_cols: int = 6) -> DataFrame:
    score = 1 - F.try_divide(F.col("missing_values").cast("double"), F.col("rows") * n_cols)
    return metrics.withColumn("quality_score", score).withColumn(
        "passed", F.col("quality_score") >= threshold
    )


def quality_gate(df: DataFrame, key: str, cols: list[str], threshold: float = 0.9,
                 n_cols: int = 6, volume: str = "volume") -> tuple[DataFrame, DataFrame]:
    """Rows of the keys that pass, and the scores of those flagged."""
    scores = completeness_scores(row_metrics(df, key, cols, volume), threshold, n_cols)
    good = df.join(scores.where("passed").select(key), key, "left_semi")
    return good, scores.where("not passed")


# -- keys -------------------------------------------------------------------------------------

def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def check_refs(model: dict[str, DataFrame], refs: list[tuple[str, str, str, str]]) -> DataFrame:
    """Rows and orphans per reference (child, child key, parent, parent key).

    Every child is read once for all its references, every parent once for all its keys; what meets
    are counts per key and distinct keys, compared as text.
    """
    def entries(items: list[tuple[str, str]]) -> F.Column:
        return F.explode(F.array(*[F.struct(F.lit(name).alias("_of"),
                                            F.col(key).cast("string").alias("_key"))
                                   for name, key in items])).alias("_e")

    children: dict[str, list[tuple[str, str]]] = {}
    parents: dict[str, set[str]] = {}
    names = []
    for child, key, parent, parent_key in refs:
        name = f"{child}.{key} > {parent}.{parent_key}"
        names.append((name, f"{parent}.{parent_key}"))
        children.setdefault(child, []).append((name, key))
        parents.setdefault(parent, set()).add(parent_key)
    counts = reduce(DataFrame.unionByName, [
        model[child].select(entries(items)).select("_e.*").where("_key is not null")
        .groupBy("_of", "_key").agg(F.count(F.lit(1)).alias("_n"))
        for child, items in children.items()])
    known = reduce(DataFrame.unionByName, [
        model[parent].select(entries([(f"{parent}.{k}", k) for k in sorted(keys)])).select("_e.*")
        .where("_key is not null").distinct() for parent, keys in parents.items()])
    target = F.lit(None).cast("string")
    for name, parent in names:
        target = F.when(F.col("_of") == name, parent).otherwise(target)
    found = counts.withColumn("_to", target).join(
        known.select(F.col("_of").alias("_to"), "_key", F.lit(True).alias("_there")),
        ["_to", "_key"], "left").groupBy("_of").agg(
        F.sum("_n").alias("rows"),
        F.sum(F.when(F.col("_there").isNull(), F.col("_n")).otherwise(0)).alias("orphans"))
    listed = known.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(name) for name, _ in names])).alias("_at", "ref"))
    return listed.join(found, F.col("ref") == F.col("_of"), "left").orderBy("_at").select(
        "ref", F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("orphans", F.lit(0)).alias("orphans"))


# -- drift ------------------------------------------------------------------------------------

def kolmogorov_p(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of the two-sample statistic."""
    root = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (root + 0.12 + F.lit(0.11) / root) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0)
        * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.04, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def column_drift(reference: DataFrame, current: DataFrame, cols: list[str], *,
                 test: str, by: list[str] | None = None, alpha: float = 0.05,
                 distance: float = 0.1, **limits: int) -> DataFrame:
    """Drift per numeric column, and per value of `by` such as a symbol.

    `test` is "ks", Kolmogorov-Smirnov at `alpha`, or "wasserstein", the distance in units of the
    reference deviation against `distance`. Both figures come from the two distribution functions
    over distinct values; the test decides. Columns with fewer than two values on a side
    are skipped; the score is kept only where drift was found.
    """
    by = list(by or [])
    keys = [*by, "column"]
    sides = unpivot(reference, cols, by).withColumn("_ref", F.lit(1)).unionByName(
        unpivot(current, cols, by).withColumn("_ref", F.lit(0))).where(F.col("value").isNotNull())
    # Everything below works on the counts, so the two tables are scanned once.
    counted = materialize(sides.groupBy(*keys, "value").agg(
        F.sum("_ref").alias("_r"), F.sum(1 - F.col("_ref")).alias("_c")), "counts")
    sizes = counted.groupBy(*keys).agg(
        F.sum("_r").alias("n_ref"), F.sum("_c").alias("n_cur"),
        F.try_divide(F.sum(F.col("_r") * F.col("value")), F.sum("_r")).alias("_mean"),
    ).where("n_ref >= 2 and n_cur >= 2")
    away = F.col("value") - F.col("_mean")
    totals = counted.join(sizes, keys).groupBy(*keys).agg(
        F.any_value("n_ref").alias("n_ref"), F.any_value("n_cur").alias("n_cur"),
        F.sqrt(F.sum(F.col("_r") * away * away) / F.any_value("n_ref")).alias("_std"))
    shares = F.abs(F.col("_cr") / F.col("n_ref") - F.col("_cc") / F.col("n_cur"))

    def gaps(d: DataFrame, w: WindowSpec) -> DataFrame:
        step = F.col("value") - F.lag("value").over(w)
        return d.withColumn("_area", F.lag("_diff").over(w) * step)

    walked = over_series(
        counted, keys, ["value"],
        lambda s: s.running(_cr=F.col("_r"), _cc=F.col("_c"))
        .select(lambda d: d.join(totals, keys).withColumn("_diff", shares)).rolling(1, gaps),
        **limits)
    measured = walked.groupBy(*keys).agg(
        F.max("_diff").alias("ks_statistic"), F.sum("_area").alias("_area"),
        F.any_value("n_ref").alias("n_ref"), F.any_value("n_cur").alias("n_cur"),
        F.any_value("_std").alias("_std"),
    )
    scored = measured.withColumns({
        "p_value": kolmogorov_p(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")),
        "wasserstein": F.coalesce("_area", F.lit(0.0)) / F.greatest("_std", F.lit(0.001)),
    })
    score = F.col({"ks": "p_value", "wasserstein": "wasserstein"}[test])
    drifted = score < alpha if test == "ks" else score >= distance
    return scored.select(
        *keys, "n_ref", "n_cur", "ks_statistic", "p_value", "wasserstein",
        F.lit(test).alias("test"), drifted.alias("drifted"),
        F.when(drifted, score).alias("drift_score"),
    )


def dataset_drift(column_drifts: DataFrame, share: float = 0.5,
                  by: list[str] | None = None) -> DataFrame:
    """A dataset drifts when at least `share` of its columns do."""
    return column_drifts.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("columns"), F.count_if("drifted").alias("drifted_columns"),
        F.try_divide(F.count_if("drifted").cast("double"), F.count(F.lit(1)))
        .alias("drift_share"),
    ).withColumn("dataset_drift", F.col("drift_share") >= share)
