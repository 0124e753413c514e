"""Read-side operators: filters, pages, decimation, latest rows, simple summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickevidence.functions.clock import block_of, to_us, us

# Page and chart limits.
MAX_PAGE = 250
MAX_TEXT = 200
CHART_POINTS = 800


def filter_rows(df: DataFrame, equal: dict[str, str], contains: str = "") -> DataFrame:
    """Equality filters (a missing column matches nothing) and a literal,
    case-insensitive substring over the text of every column."""
    for value in [*equal.values(), contains]:
        if not isinstance(value, str) or len(value) > MAX_TEXT:
            raise ValueError("filters are strings of at most 200 characters")
    out = df
    for column, value in equal.items():
        if value:
            test = F.col(column).cast("string") == value if column in df.columns else F.lit(False)
            out = out.filter(test)
    if contains:
        found = F.lit(False)
        for c in df.columns:
            found = found | F.coalesce(F.contains(F.lower(F.col(f"`{c}`").cast("string")), F.lit(contains.lower())), F.lit(False))
        out = out.filter(found)
    return out


def page(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """One page in a stable order."""
    for value in (offset, limit):
        if isinstance(value, bool) or not isinstance(value, int):
            raise ValueError("offset and limit are whole numbers")
    if offset < 0 or not 1 <= limit <= MAX_PAGE:
        raise ValueError("offset must be nonnegative and limit within 1 to 250")
    return df.orderBy(*order).offset(offset).limit(limit)


def preview(df: DataFrame, columns: list[str], order: list[str], limit: int = 25) -> tuple[DataFrame, Column]:
    """The first rows of selected columns, and the total as a scalar column."""
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return df.select(*columns).orderBy(*order).limit(limit), total


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key. ``max_by`` combines map-side, so hot keys are cheap."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*keys, "_row.*")


def decimate(
    df: DataFrame, *, by: list[str], time: str, points: int = CHART_POINTS, block_seconds: float
) -> DataFrame:
    """At most ``points`` evenly spaced rows per key, first and last included.

    A row's place is its rank inside a time block plus the sizes of earlier
    blocks, so a long series is never sorted in one task. Segments must be
    numbered before: spacing out rows must not create gaps.
    """
    tagged = df.withColumn("_blk", block_of(us(time), to_us(block_seconds)))
    sizes = tagged.groupBy(*by, "_blk").agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy(*by).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    carry = sizes.select(
        *[F.col(c).alias(f"_c_{c}") for c in [*by, "_blk"]],
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(W.partitionBy(*by)).alias("_n"),
    )
    inside = W.partitionBy(*by, "_blk").orderBy(time)
    ranked = tagged.withColumn("_rn", F.row_number().over(inside))
    cond = F.lit(True)
    for c in [*by, "_blk"]:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
    placed = ranked.join(carry, cond).withColumn("_i", F.col("_before") + F.col("_rn") - 1)
    # Row i is kept when some j of 0..points-1 rounds (half to even) to it.
    scale = (F.col("_n") - 1) / F.lit(float(points - 1))
    j = F.round(F.col("_i") / scale)
    near = F.lit(False)
    for d in (-1, 0, 1):
        c = j + d
        near = near | ((c >= 0) & (c <= points - 1) & (F.rint(c * (F.col("_n") - 1) / F.lit(float(points - 1))) == F.col("_i")))
    return placed.filter((F.col("_n") <= points) | near).drop(
        "_blk", "_rn", "_i", "_before", "_n", *[f"_c_{c}" for c in [*by, "_blk"]]
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) with NULL shown as MISSING."""
    items = F.array(
        *[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("MISSING")).alias("value")) for c in columns]
    )
    return df.select(F.inline(items)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def issue_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Count the parts of separated issue lists; ``columns`` maps a column to its separator pattern."""
    parts = F.flatten(
        F.array(*[F.coalesce(F.split(F.col(c), sep), F.expr("cast(array() as array<string>)")) for c, sep in columns.items()])
    )
    return (
        df.select(F.explode(parts).alias("issue"))
        .filter(F.col("issue") != "")
        .groupBy("issue")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def eligible_version(df: DataFrame, column: str, version: str) -> tuple[DataFrame, DataFrame]:
    """Rows of one source version, and counts of the excluded versions."""
    keep = F.coalesce(F.col(column) == version, F.lit(False))
    excluded = (
        df.filter(~keep)
        .groupBy(F.coalesce(F.col(column), F.lit("MISSING")).alias("version"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return df.filter(keep), excluded


def target_only(df: DataFrame, column: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Rows of one instrument, and counts of the others."""
    if not isinstance(target, str) or not target.strip():
        raise ValueError("name one target instrument")
    others = df.filter(F.col(column) != target).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return df.filter(F.col(column) == target), others


def target_events(samples: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    return samples.filter(F.col("label").isin(*labels))
