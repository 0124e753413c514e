"""Exact quantiles, average ranks and guarded correlations that scale.

Nothing here sorts a whole group in one task. Values are first counted, then cut
into value ranges at cuts taken from an approximate quantile of the whole column
(a scalar subquery, so every task sees the same cuts). Ranges of a hot group lie
in many tasks; counts of earlier ranges are added. The cuts only steer the
spread: results are exact whatever they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGES = 32


def finite(col: Column) -> Column:
    """The value, or NULL when it is NaN or infinite."""
    value = col.cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def ranked_values(
    df: DataFrame, by: list[str], value: str, count: str | None = None, cut_by: str | None = None
) -> DataFrame:
    """One row per (group, value): ``n`` copies, ``below`` smaller rows, ``total``.

    ``count`` names a column holding multiplicities when ``df`` is already counted.
    ``cut_by`` names a group column with a short fixed list of values (feature
    names, say) whose value scales differ, so that each gets cuts of its own.
    """
    known = df.filter(F.col(value).isNotNull())
    freq = known.groupBy(*by, value).agg(
        (F.sum(count) if count else F.count(F.lit(1))).cast("bigint").alias("n")
    )
    probs = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    none = F.array().cast("array<double>")
    if cut_by:
        each = known.groupBy(cut_by).agg(F.percentile_approx(value, probs, 1000).cast("array<double>").alias("cuts"))
        table = each.agg(F.map_from_entries(F.collect_list(F.struct(cut_by, "cuts"))).alias("cuts")).scalar()
        cuts = F.coalesce(table[F.col(cut_by)], none)
    else:
        cuts = F.coalesce(
            known.agg(F.percentile_approx(value, probs, 1000).cast("array<double>").alias("cuts")).scalar(), none
        )
    ranged = (
        freq.withColumn("_cuts", cuts)
        .withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col(value))))
        .drop("_cuts")
    )
    keys = [*by, "_range"]
    sums = ranged.groupBy(*keys).agg(F.sum("n").alias("_n"))
    earlier = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carry = sums.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(W.partitionBy(*by)).alias("total"),
    )
    inside = W.partitionBy(*keys).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    local = ranged.withColumn("_below", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    return local.join(carry, cond).select(
        *by, value, "n", (F.col("_below") + F.col("_before")).alias("below"), "total"
    )


def exact_quantiles(
    df: DataFrame,
    by: list[str],
    value: str,
    probs: list[float],
    names: list[str] | None = None,
    cut_by: str | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group, with ``n`` and ``distinct_values``."""
    names = names or [f"q{int(round(p * 100)):02d}" for p in probs]
    ranked = ranked_values(df, by, value, cut_by=cut_by)
    spots, outs = [], []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("total") - 1)
        for tag, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            held = (F.col("below") <= rank) & (rank < F.col("below") + F.col("n"))
            spots.append(F.max(F.when(held, F.col(value))).alias(f"_{tag}{i}"))
    spots += [F.max("total").alias("n"), F.count(F.lit(1)).alias("distinct_values")]
    picked = ranked.groupBy(*by).agg(*spots)
    for i, (p, name) in enumerate(zip(probs, names)):
        at = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outs.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return picked.select(*by, "n", "distinct_values", *outs)


def average_ranks(df: DataFrame, by: list[str], value: str, count: str | None = None) -> DataFrame:
    """Rank of each (group, value), ties sharing the mean of their places."""
    return ranked_values(df, by, value, count).select(
        *by,
        value,
        "n",
        "total",
        (F.col("below") + (F.col("n") + 1) / F.lit(2.0)).alias("average_rank"),
    )


def _moments_corr(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    vx, vy = sxx - sx * sx / n, syy - sy * sy / n
    return F.when((vx > 0) & (vy > 0), (sxy - sx * sy / n) / (F.sqrt(vx) * F.sqrt(vy)))


def correlations(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Pearson and Spearman over pairwise complete rows, per group.

    NULL unless there are at least three pairs and both sides vary. Ranks are
    those inside each group, so a pooled group needs its own pooled rows (see
    :func:`with_pooled`).
    """
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    counted = pairs.groupBy(*by, x, y).agg(F.count(F.lit(1)).alias("w"))
    rx = _ranks_for(counted, by, x, "_rx")
    ry = _ranks_for(counted, by, y, "_ry")
    ranked = _join_ranks(_join_ranks(counted, rx, by, x, "_rx"), ry, by, y, "_ry")
    w = F.col("w")
    # Rank means are known exactly, so centred sums lose no precision.
    cx = F.col("_rx") - (F.col("_total") + 1) / F.lit(2.0)
    cy = F.col("_ry") - (F.col("_total") + 1) / F.lit(2.0)
    rank_part = ranked.groupBy(*by).agg(
        F.sum(w * cx * cx).alias("_vx"), F.sum(w * cy * cy).alias("_vy"), F.sum(w * cx * cy).alias("_vxy")
    )
    # Centre on one value of the group: shifts cancel, large levels do not.
    spread = pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(x).alias("_x0"), F.max(x).alias("_x1"),
        F.min(y).alias("_y0"), F.max(y).alias("_y1"),
        F.covar_pop(x, y).alias("_cov"), F.var_pop(x).alias("_varx"), F.var_pop(y).alias("_vary"),
    )
    usable = (F.col("n") >= 3) & (F.col("_x0") < F.col("_x1")) & (F.col("_y0") < F.col("_y1"))
    return _null_safe_join(spread, rank_part, by).select(
        *by,
        "n",
        F.when(usable, F.col("_cov") / F.sqrt(F.col("_varx") * F.col("_vary"))).alias("pearson"),
        F.when(usable, F.col("_vxy") / F.sqrt(F.col("_vx") * F.col("_vy"))).alias("spearman"),
    )


def _ranks_for(counted: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    ranks = average_ranks(counted, by, value, count="w")
    return ranks.select(
        *[F.col(c).alias(f"_k_{c}") for c in by],
        F.col(value).alias("_k_value"),
        F.col("average_rank").alias(name),
        F.col("total").alias("_total"),
    )


def _join_ranks(df: DataFrame, ranks: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Ranks are unique per (group, value); a hot value is left to AQE's skew split."""
    cond = F.col(value) == F.col("_k_value")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    if "_total" in df.columns:
        ranks = ranks.drop("_total")
    return df.join(ranks, cond).drop("_k_value", *[f"_k_{c}" for c in by])


def _null_safe_join(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    right = right.select(
        *[F.col(c).alias(f"_k_{c}") for c in by], *[c for c in right.columns if c not in by]
    )
    cond = F.lit(True)
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return left.join(right, cond).drop(*[f"_k_{c}" for c in by])


def with_pooled(df: DataFrame, column: str, label: str = "POOLED") -> DataFrame:
    """Every row once under its own group and once under ``label``."""
    return df.withColumn(column, F.explode(F.array(F.col(column).cast("string"), F.lit(label))))


def unpivot(df: DataFrame, ids: list[str], columns: list[str], key: str, value: str) -> DataFrame:
    """Long form, one row per (row, column); values become finite doubles or NULL."""
    items = [F.struct(F.lit(c).alias(key), finite(F.col(c)).alias(value)) for c in columns]
    return df.select(*ids, F.inline(F.array(*items)))


def interval_summary(
    df: DataFrame, by: list[str], seconds: str, changes: dict[str, str], contract: str
) -> DataFrame:
    """Count, exact median / min / max length, zero changes and distinct contracts."""
    base = df.groupBy(*by).agg(
        F.min(seconds).alias("seconds_min"),
        F.max(seconds).alias("seconds_max"),
        *[F.count_if(F.col(c) == 0).alias(name) for name, c in changes.items()],
    )
    contracts = df.groupBy(*by, contract).agg(F.lit(1).alias("_one")).groupBy(*by).agg(
        F.count(contract).alias("distinct_contracts")
    )
    middle = exact_quantiles(df, by, seconds, [0.5], ["seconds_median"]).drop("distinct_values")
    return _null_safe_join(_null_safe_join(middle, base, by), contracts, by)
