"""Provenance joins: match counts and evidence without multiplying rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def match_evidence(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    *,
    name: str,
    maxima: dict[str, str] | None = None,
    evidence: list[str] | None = None,
) -> DataFrame:
    """Left join an aggregate of the matches: never more or fewer left rows.

    Adds ``{name}_match_count``, the maximum of each ``maxima`` column, and
    ``{name}_evidence``: the matching row as a struct when there is exactly one,
    else NULL. Several matches are ambiguous and no consumer may pick one, so they
    are not gathered into an array here; :func:`ambiguous_evidence` lists them
    all as rows. The right side combines map-side and is unique per key, so a hot
    key costs one row of it.
    """
    count = F.count(F.lit(1))
    items = [count.alias(f"{name}_match_count")]
    items += [F.max(c).alias(alias) for alias, c in (maxima or {}).items()]
    if evidence:
        only = F.max(F.struct(*evidence))
        items.append(F.when(count == 1, only).alias(f"{name}_evidence"))
    grouped = right.groupBy(*on).agg(*items)
    joined = left.join(grouped, on, "left")
    return joined.withColumn(
        f"{name}_match_count", F.coalesce(F.col(f"{name}_match_count"), F.lit(0).cast("bigint"))
    )


def ambiguous_evidence(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Every right row of a key that has several matches and at least one left row."""
    repeated = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    wanted = repeated.join(left.select(*on).distinct(), on, "left_semi")
    return right.join(wanted, on, "left_semi")


def nested_candidates(
    left: DataFrame,
    candidates: DataFrame,
    inner: DataFrame,
    *,
    on: list[str],
    parent: str,
    inner_on: dict[str, str],
    evidence: list[str],
    inner_evidence: list[str],
) -> DataFrame:
    """Candidates of each left row, each with its own matched inner rows.

    Inner rows match by the left row's ``parent`` id plus ``inner_on``
    (candidate column -> inner column). Adds ``candidate_count`` and, when there is
    one candidate, ``candidate`` with ``receipt_count`` and its only receipt.
    """
    renamed = {f"_i_{col}": col for col in inner_on.values()}
    receipts = inner.select(
        F.col("parent_id").alias("_i_parent"),
        *[F.col(c).alias(a) for a, c in renamed.items()],
        F.struct(*inner_evidence).alias("_receipt"),
    )
    keys = ["_i_parent", *renamed]
    grouped = receipts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("receipt_count"),
        F.when(F.count(F.lit(1)) == 1, F.max("_receipt")).alias("receipt"),
    )
    left_keys = left.select(*on, F.col(parent).alias("_parent")).distinct()
    linked = candidates.join(left_keys, on)
    cond = F.col("_parent") == F.col("_i_parent")
    for cand_col, inner_col in inner_on.items():
        cond = cond & (F.col(cand_col) == F.col(f"_i_{inner_col}"))
    linked = linked.join(grouped, cond, "left").withColumn(
        "receipt_count", F.coalesce("receipt_count", F.lit(0).cast("bigint"))
    )
    each = linked.groupBy(*on, "_parent").agg(
        F.count(F.lit(1)).alias("candidate_count"),
        F.when(
            F.count(F.lit(1)) == 1, F.max(F.struct(*evidence, "receipt_count", "receipt"))
        ).alias("candidate"),
    )
    cond = F.col(parent).eqNullSafe(F.col("_parent"))
    right = each.select(*[F.col(c).alias(f"_r_{c}") for c in on], "_parent", "candidate_count", "candidate")
    for c in on:
        cond = cond & (F.col(c) == F.col(f"_r_{c}"))
    out = left.join(right, cond, "left").drop("_parent", *[f"_r_{c}" for c in on])
    return out.withColumn("candidate_count", F.coalesce("candidate_count", F.lit(0).cast("bigint")))


def nested_ambiguities(
    left: DataFrame,
    candidates: DataFrame,
    inner: DataFrame,
    *,
    on: list[str],
    parent: str,
    inner_on: dict[str, str],
    evidence: list[str],
    inner_evidence: list[str],
) -> DataFrame:
    """What :func:`nested_candidates` only counts, one row each: (on, parent, kind, evidence, inner evidence).

    ``candidate`` rows where a left row has several, ``receipt`` rows where its only candidate has
    several. Rows are joined to the keys that are ambiguous, never gathered by key.
    """
    keys = left.select(*on, F.col(parent).alias("parent")).distinct().withColumn("_pk", F.to_json(F.struct("parent")))
    linked = candidates.select(*on, *{*evidence, *inner_on}).join(keys, on)
    name = [*on, "_pk"]
    counts = linked.groupBy(*name).agg(F.count(F.lit(1)).alias("_n"))
    several = linked.join(counts.filter("_n > 1").drop("_n"), name)
    blank = [F.lit(None).cast(inner.schema[c].dataType).alias(c) for c in inner_evidence]
    listed = several.select(*on, "parent", F.lit("candidate").alias("kind"), *evidence, *blank)
    receipts = inner.select(F.col("parent_id").alias("parent"), *[F.col(i).alias(f"_i_{c}") for c, i in inner_on.items()], *inner_evidence)
    only = linked.join(counts.filter("_n = 1").drop("_n"), name)
    same = F.col("l.parent") == F.col("r.parent")
    for c in inner_on:
        same = same & (F.col(f"l.{c}") == F.col(f"r._i_{c}"))
    met = only.alias("l").join(receipts.alias("r"), same).select("l.*", *[F.col(f"r.{c}") for c in inner_evidence])
    repeated = met.groupBy(*name).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    met = met.join(repeated, name)
    return listed.unionByName(met.select(*on, "parent", F.lit("receipt").alias("kind"), *evidence, *inner_evidence))


def issue_list(*checks: tuple[Column, str]) -> Column:
    """Names of the checks that hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, name) for cond, name in checks]))


def integrity_issues(trading_date: Column) -> Column:
    """Issues of an exported option row from its match counts and provenance.

    Expects ``market_match_count``, ``market_trading_date``, ``market_version``,
    ``market_status``, ``receipt_match_count``, ``receipt_basis``,
    ``receipt_freshness``, ``trading_date``, ``version`` and ``data_status``.
    """
    c = F.col
    v2 = F.coalesce(c("version") == 2, F.lit(False))
    one_market = c("market_match_count") == 1
    one_receipt = c("receipt_match_count") == 1

    def differs(col: Column, want) -> Column:
        return ~col.eqNullSafe(want if isinstance(want, Column) else F.lit(want))

    provenance = differs(c("receipt_basis"), "APPLICATION_RECEIPT") | differs(
        c("receipt_freshness"), "UNVERIFIED_PROVIDER_TIME"
    )
    return issue_list(
        (c("market_match_count") == 0, "missing_market_snapshot"),
        (c("market_match_count") > 1, "ambiguous_market_snapshot"),
        (one_market & differs(c("market_trading_date"), trading_date), "market_trading_date_mismatch"),
        (differs(c("trading_date"), trading_date), "option_trading_date_mismatch"),
        (v2 & (c("receipt_match_count") == 0), "missing_raw_receipt"),
        (v2 & (c("receipt_match_count") > 1), "ambiguous_raw_receipt"),
        (v2 & one_receipt & provenance, "raw_receipt_provenance_mismatch"),
        (
            v2 & one_market & (differs(c("market_version"), 2) | differs(c("market_status"), "PARTIAL")),
            "market_provenance_mismatch",
        ),
        (v2 & differs(c("data_status"), "PARTIAL"), "option_provenance_mismatch"),
        (~v2 & differs(c("version"), 1), "unsupported_source_version"),
    )


def canonical_rows(rows: DataFrame, trading_date: Column, spot: str) -> DataFrame:
    """Add issues, the timestamp source they imply, and a spot that is NULL on any issue."""
    tagged = rows.withColumn("issues", integrity_issues(trading_date))
    clean = F.size("issues") == 0
    source = (
        F.when(F.col("version") != 2, "UNVERIFIED_LEGACY_TIME")
        .when(clean, "APPLICATION_RECEIPT")
        .otherwise("UNVERIFIED_SOURCE_INTEGRITY")
    )
    return tagged.withColumn("timestamp_source", F.coalesce(source, F.lit("UNVERIFIED_LEGACY_TIME"))).withColumn(
        "canonical_spot", F.when(clean, F.col(spot))
    )


def orphans(rows: DataFrame, children: DataFrame, on: list[str]) -> DataFrame:
    """Rows with no child at their key."""
    return rows.join(children, on, "left_anti")


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Joined rows, and one row of violation counts (all must be zero).

    Keys must be unique and non-null on both sides, the key sets equal, and the
    shared columns null-safely equal.
    """
    shared = [c for c in left.columns if c in right.columns and c != key]
    ids = (
        left.select(F.col(key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(F.col(key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r")))
        .groupBy("k")
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    )
    keys = ids.agg(
        F.count_if(F.col("k").isNull()).alias("null_keys"),
        F.count_if((F.col("l") > 1) | (F.col("r") > 1)).alias("repeated_keys"),
        F.count_if((F.col("l") == 0) | (F.col("r") == 0)).alias("unmatched_keys"),
    )
    other = right.select(key, *[F.col(c).alias(f"_r_{c}" if c in shared else c) for c in right.columns if c != key])
    joined = left.join(other, key)
    differ = F.lit(False)
    for c in shared:
        differ = differ | ~F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    conflicts = joined.agg(F.count_if(differ).alias("n")).scalar()
    return joined.drop(*[f"_r_{c}" for c in shared]), keys.withColumn("shared_column_conflicts", conflicts)


def static_mapping(known: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that carry exactly one distinct value: (key, value)."""
    pairs = known.filter(F.col(value).isNotNull()).groupBy(key).agg(
        F.min(value).alias(value), F.max(value).alias("_max")
    )
    return pairs.filter(F.col(value) == F.col("_max")).drop("_max")


def fill_from_mapping(rows: DataFrame, mapping: DataFrame, key: str, value: str, source: str) -> DataFrame:
    """Fill a missing identity from an unambiguous mapping; records where it came from."""
    right = mapping.select(key, F.col(value).alias("_mapped"))
    joined = rows.join(right, key, "left")
    filled = F.col(value).isNull() & F.col("_mapped").isNotNull()
    return (
        joined.withColumn(source, F.when(filled, "stored_contract_mapping"))
        .withColumn(value, F.coalesce(value, "_mapped"))
        .drop("_mapped")
    )


def accepted_children(children: DataFrame, parents: DataFrame, links: dict[str, str]) -> DataFrame:
    """Tag derived rows with ``parent_reason`` (NULL = a matching RAW parent exists).

    ``links`` maps a child column to a parent column; the first link is the id.
    """
    (id_child, id_parent), *rest = links.items()
    right = parents.groupBy(F.col(id_parent).alias("_p")).agg(
        *[F.min(p).alias(f"_p_{p}") for _, p in rest]
    )
    joined = children.join(right, F.col(id_child) == F.col("_p"), "left")
    reason = F.when(F.col("_p").isNull(), "parent_missing")
    for child, parent in rest:
        reason = reason.when(~F.col(child).eqNullSafe(F.col(f"_p_{parent}")), f"parent_{parent}_mismatch")
    return joined.withColumn("parent_reason", reason).drop("_p", *[f"_p_{p}" for _, p in rest])


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, with the side: empty when both id sets are equal."""
    ids = left.select(key).withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0)).unionByName(
        right.select(key).withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))
    )
    seen = ids.groupBy(key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return seen.filter(F.col("_l") != F.col("_r")).select(
        key, F.when(F.col("_l") == 1, "left_only").otherwise("right_only").alias("side")
    )


def compare_tables(
    stored: DataFrame, recomputed: DataFrame, keys: list[str], tolerance: float = 1e-12
) -> DataFrame:
    """Rows that differ between two tables, as (keys, problem).

    Multisets are compared: each key is counted first. Doubles agree within a
    relative or absolute ``tolerance``; NULL equals only NULL.
    """
    values = [c for c in recomputed.columns if c not in keys]
    if set(stored.columns) != set(recomputed.columns):
        raise ValueError("tables have different columns")
    floats = {f.name for f in recomputed.schema.fields if f.dataType.typeName() in ("double", "float")}

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"_n{tag}"), *[F.first(c).alias(f"_{tag}_{c}") for c in values]
        )

    a, b = side(stored, "a"), side(recomputed, "b")
    b = b.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = a.join(b, cond, "full_outer")
    differ = F.lit(False)
    for c in values:
        x, y = F.col(f"_a_{c}"), F.col(f"_b_{c}")
        if c in floats:
            size = F.greatest(F.abs(x), F.abs(y)) * tolerance
            same = F.abs(x - y) <= F.greatest(size, F.lit(tolerance))
            differ = differ | ~F.coalesce(same, x.isNull() & y.isNull())
        else:
            differ = differ | ~x.eqNullSafe(y)
    problem = (
        F.when(F.col("_nb").isNull(), "only_stored")
        .when(F.col("_na").isNull(), "only_recomputed")
        .when((F.col("_na") > 1) | (F.col("_nb") > 1), "repeated_key")
        .when(differ, "values_differ")
    )
    return joined.select(
        *[F.coalesce(F.col(k), F.col(f"_k_{k}")).alias(k) for k in keys], problem.alias("problem")
    ).filter(F.col("problem").isNotNull())
