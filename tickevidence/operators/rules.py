"""Threshold rules: exhaustive search on early sessions, scan over all of them.

A search never pairs samples with rules. Samples are first reduced to counts per
cell (which side of each threshold a sample lies on, and its label); there are a
few hundred cells at most, and every rule's counts are sums over cells.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickevidence.functions.clock import to_us
from tickevidence.operators.sampling import FEATURES, SamplePolicy, policy_text
from tickevidence.operators.segments import greedy_spacing
from tickevidence.operators.stats import exact_quantiles, finite, unpivot

SINGLE = "single-feature-training-quantiles-v1"
JOINT = "joint-ce-pe-iv-training-v2"
# Paired observation families of the joint search, and the operators.
JOINT_FAMILIES = ("past_midpoint_return_pct", "past_oi_change_pct", "past_volume_increment")
OPERATORS = (">=", "<=")
PREDICATES = "array<struct<feature:string,operator:string,threshold:double>>"


@dataclass(frozen=True)
class SearchPolicy:
    discovery_fraction: float = 0.6
    discovery_end: str | None = None
    min_support: int = 5
    max_conditions: int = 6
    discovery_version: str = JOINT

    def __post_init__(self) -> None:
        if self.discovery_version not in (SINGLE, JOINT):
            raise ValueError("unsupported discovery version")
        if not 0 < self.discovery_fraction < 1 or self.min_support < 1 or self.max_conditions < 1:
            raise ValueError("search limits must be positive and the fraction inside (0, 1)")


def check_predicates(predicates: list[dict], discovery_version: str) -> list[dict]:
    """Validate the restricted predicate language; raise on anything else."""
    for term in predicates:
        if set(term) != {"feature", "operator", "threshold"}:
            raise ValueError("a predicate has exactly feature, operator and threshold")
        if term["feature"] not in FEATURES or term["operator"] not in OPERATORS:
            raise ValueError("unsupported feature or operator")
        limit = term["threshold"]
        if isinstance(limit, bool) or not isinstance(limit, (int, float)) or not abs(limit) < float("inf"):
            raise ValueError("a threshold must be finite")
    names = [t["feature"] for t in predicates]
    if discovery_version == JOINT:
        paired = any(names[:2] == [f"CE_{f}", f"PE_{f}"] for f in JOINT_FAMILIES)
        if len(names) != 4 or not paired or names[2:] != ["CE_iv_decimal", "PE_iv_decimal"]:
            raise ValueError("a joint rule pairs one CE/PE family with both IVs")
    elif discovery_version == SINGLE:
        if len(names) != 1:
            raise ValueError("a single-feature rule has one predicate")
    else:
        raise ValueError("unsupported discovery version")
    return predicates


def predicate_column(predicates: list[dict]) -> tuple[Column, Column]:
    """(available, matched) of literal predicates on a sample row."""
    available, matched = F.lit(True), F.lit(True)
    for term in predicates:
        value = finite(F.col(term["feature"]))
        available = available & value.isNotNull()
        test = value >= term["threshold"] if term["operator"] == ">=" else value <= term["threshold"]
        matched = matched & test
    return available, available & F.coalesce(matched, F.lit(False))


def partition_days(samples: DataFrame, policy: SearchPolicy) -> DataFrame:
    """(trading_date, partition): whole sessions, early ones for discovery.

    One row per calendar day with samples, so the ordering window is small. With
    fewer than two days everything is discovery.
    """
    days = samples.select("trading_date").distinct()
    if policy.discovery_end:
        early = F.col("trading_date") <= F.lit(policy.discovery_end).cast(samples.schema["trading_date"].dataType)
        return days.withColumn("partition", F.when(early, "discovery").otherwise("evaluation"))
    place = F.row_number().over(W.orderBy("trading_date"))
    total = F.count(F.lit(1)).over(W.partitionBy())
    share = F.floor(total * F.lit(float(policy.discovery_fraction)))
    train = F.least(total - 1, F.greatest(F.lit(1), share))
    early = (total < 2) | (place <= train)
    return days.select("trading_date", F.when(early, "discovery").otherwise("evaluation").alias("partition"))


def with_partition(samples: DataFrame, policy: SearchPolicy) -> DataFrame:
    """Samples with their partition; the day table is one row per calendar day."""
    return samples.join(F.broadcast(partition_days(samples, policy)), "trading_date")


def training_rows(samples: DataFrame, policy: SearchPolicy) -> DataFrame:
    """Known rows of the discovery sessions; none unless there are evaluation sessions as well.

    A rule without a session to test it on must not be frozen.
    """
    days = partition_days(samples, policy).withColumn("_one", F.lit(1))
    tests = days.filter("partition = 'evaluation'").select("_one").distinct()
    ready = days.filter("partition = 'discovery'").join(tests, "_one", "left_semi").drop("_one")
    return samples.join(F.broadcast(ready), "trading_date").filter(F.col("label") != "UNKNOWN")  # one row per calendar day


def single_thresholds(train: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """(feature, thresholds): distinct quartiles; features without two values are skipped."""
    values = unpivot(train, [], list(features), "feature", "value")
    quartiles = exact_quantiles(values, ["feature"], "value", [0.25, 0.5, 0.75], cut_by="feature")
    return quartiles.filter(F.col("distinct_values") >= 2).select(
        "feature", F.array_sort(F.array_distinct(F.array("q25", "q50", "q75"))).alias("thresholds")
    )


def joint_thresholds(train: DataFrame) -> DataFrame:
    """(family, tuples): distinct paired quartiles with both IV medians, complete rows only."""
    rows = _family_rows(train)
    values = rows.select(
        "family",
        F.inline(F.array(*[F.struct(F.lit(i).alias("place"), F.col(f"v{i}").alias("value")) for i in range(4)])),
    ).withColumn("slot", F.concat_ws("/", "family", F.col("place").cast("string")))
    q = exact_quantiles(values, ["family", "place", "slot"], "value", [0.25, 0.5, 0.75], cut_by="slot")
    wide = q.groupBy("family").agg(
        F.min("distinct_values").alias("least_distinct"),
        *[
            F.max(F.when(F.col("place") == i, F.col(name))).alias(f"{name}_{i}")
            for i in range(4)
            for name in ("q25", "q50", "q75")
        ],
    )
    tuples = [
        F.array(F.col(f"{name}_0"), F.col(f"{name}_1"), F.col("q50_2"), F.col("q50_3"))
        for name in ("q25", "q50", "q75")
    ]
    return wide.filter(F.col("least_distinct") >= 2).select(
        "family", F.array_sort(F.array_distinct(F.array(*tuples))).alias("tuples")
    )


def _family_names(family: str) -> list[str]:
    return [f"CE_{family}", f"PE_{family}", "CE_iv_decimal", "PE_iv_decimal"]


def _family_rows(samples: DataFrame, *keep: str) -> DataFrame:
    items = [
        F.struct(
            F.lit(f).alias("family"),
            *[finite(F.col(name)).alias(f"v{i}") for i, name in enumerate(_family_names(f))],
        )
        for f in JOINT_FAMILIES
    ]
    rows = samples.select(*keep, F.inline(F.array(*items)))
    complete = F.lit(True)
    for i in range(4):
        complete = complete & F.col(f"v{i}").isNotNull()
    return rows.filter(complete)


def _hits(targets: tuple[str, str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n")] + [
        F.count_if(F.col("label") == t).alias(f"hit{i}") for i, t in enumerate(targets)
    ]


def _target_items(targets: tuple[str, str]) -> Column:
    return F.array(
        *[F.struct(F.lit(t).alias("target"), F.col(f"hit{i}").alias("hit")) for i, t in enumerate(targets)]
    )


def _search_single(train: DataFrame, targets: tuple[str, str]) -> DataFrame:
    limits = F.broadcast(single_thresholds(train))  # one row per feature name
    values = unpivot(train, ["label"], list(FEATURES), "feature", "value").filter("value is not null")
    placed = values.join(limits, "feature").select(
        "feature",
        "label",
        "thresholds",
        F.size(F.filter("thresholds", lambda t: t <= F.col("value"))).alias("reached"),
        F.size(F.filter("thresholds", lambda t: t < F.col("value"))).alias("passed"),
    )
    cells = placed.groupBy("feature", "thresholds", "reached", "passed").agg(*_hits(targets))
    ops = F.array(*[F.lit(o) for o in OPERATORS])
    rules = (
        cells.select("*", F.posexplode("thresholds").alias("_i", "threshold"))
        .withColumn("operator", F.explode(ops))
        .withColumn(
            "matched",
            F.when(F.col("operator") == ">=", F.col("_i") < F.col("reached")).otherwise(
                F.col("_i") >= F.col("passed")
            ),
        )
        .withColumn(
            "predicates", F.array(F.struct("feature", "operator", "threshold")).cast(PREDICATES)
        )
    )
    return rules.select("predicates", "matched", "n", F.inline(_target_items(targets)))


def _search_joint(train: DataFrame, targets: tuple[str, str]) -> DataFrame:
    limits = F.broadcast(joint_thresholds(train))  # one row per family
    rows = _family_rows(train, "label").join(limits, "family")
    signs = [F.signum(F.col(f"v{i}") - F.col("_t")[i]).cast("int").alias(f"s{i}") for i in range(4)]
    signed = rows.withColumn("_t", F.explode("tuples")).select("family", "label", "_t", *signs)
    cells = signed.groupBy("family", "_t", *[f"s{i}" for i in range(4)]).agg(*_hits(targets))
    combos = [F.array(*[F.lit(o) for o in ops]) for ops in product(OPERATORS, repeat=4)]
    rules = cells.withColumn("_ops", F.explode(F.array(*combos)))
    matched = F.lit(True)
    terms = []
    for i in range(4):
        up = F.col("_ops")[i] == ">="
        matched = matched & F.when(up, F.col(f"s{i}") >= 0).otherwise(F.col(f"s{i}") <= 0)
        side = ("CE_", "PE_")[i % 2]
        name = F.concat(F.lit(side), F.col("family")) if i < 2 else F.lit(side + "iv_decimal")
        terms.append(F.struct(name.alias("feature"), F.col("_ops")[i].alias("operator"), F.col("_t")[i].alias("threshold")))
    return rules.select(
        F.array(*terms).cast(PREDICATES).alias("predicates"),
        matched.alias("matched"),
        "n",
        F.inline(_target_items(targets)),
    )


def condition_id(rule: Column, context: str) -> Column:
    """Identity of a rule: hash of its terms, target and research context."""
    return F.sha2(
        F.to_json(
            F.struct(
                F.lit(context).alias("context"),
                F.lit("UNKNOWN").alias("null_policy"),
                rule["predicates"].alias("predicates"),
                rule["target"].alias("target"),
            )
        ),
        256,
    )


def rule_context(dataset_id: str, sampling: SamplePolicy, search: SearchPolicy) -> str:
    return "|".join(
        (
            dataset_id,
            policy_text(sampling),
            f"{search.discovery_version};{search.discovery_fraction};{search.discovery_end};"
            f"{search.min_support};{search.max_conditions}",
        )
    )


def search_log(
    samples: DataFrame, sampling: SamplePolicy, search: SearchPolicy, dataset_id: str = "unspecified_dataset"
) -> DataFrame:
    """Every tested hypothesis with support, successes, rates, lift and eligibility.

    Only discovery sessions with known outcomes count. The base rate is over rows
    where every feature of the rule is available, not over all rows.
    """
    train = training_rows(samples, search)
    run = _search_single if search.discovery_version == SINGLE else _search_joint
    tallies = (
        run(train, sampling.targets())
        .groupBy("predicates", "target")
        .agg(
            F.sum(F.when(F.col("matched"), F.col("n")).otherwise(0)).alias("support"),
            F.sum(F.when(F.col("matched"), F.col("hit")).otherwise(0)).alias("successes"),
            F.sum("n").alias("available"),
            F.sum("hit").alias("available_successes"),
        )
    )
    rate = F.try_divide("successes", "support")
    base = F.try_divide("available_successes", "available")
    context = rule_context(dataset_id, sampling, search)
    scored = (
        tallies.withColumn("base_rate", base)
        .withColumn("rate", rate)
        .withColumn("lift", F.when(F.col("base_rate") > 0, F.col("rate") / F.col("base_rate")))
        .withColumn("condition_id", condition_id(F.struct("predicates", "target"), context))
    )
    eligible = (
        (F.col("support") >= search.min_support) & (F.col("successes") > 0) & (F.col("lift") > 1)
    )
    return scored.withColumn("eligible", F.coalesce(eligible, F.lit(False))).select(
        "condition_id", "predicates", "target", "support", "successes", "base_rate", "rate", "lift", "eligible"
    )


def top_rules(log: DataFrame, limit: int, tie_break: list[str] | None = None) -> DataFrame:
    """The best eligible rules: lift, successes, support, then id."""
    order = [F.desc("lift"), F.desc("successes"), F.desc("support"), *(tie_break or ["condition_id"])]
    return log.filter("eligible").orderBy(*order).limit(limit)


def modified_rules(rules: DataFrame, context: str) -> DataFrame:
    """Frozen rules whose content no longer hashes to their id (must be empty)."""
    return rules.filter(
        ~F.col("condition_id").eqNullSafe(condition_id(F.struct("predicates", "target"), context))
    )


def evaluate_rules(samples: DataFrame, rules: DataFrame, context: str | None = None) -> DataFrame:
    """Samples with one row per frozen rule: ``available`` and ``matched``.

    The rules (at most ``max_conditions``) reach the tasks as one array from a
    scalar subquery; samples are not shuffled or joined. With ``context`` every rule must still
    hash to its id, else the job fails and names the rule: a modified rule is never scanned.
    """
    name = F.col("condition_id")
    if context is not None:
        same = name.eqNullSafe(condition_id(F.struct("predicates", "target"), context))
        name = F.when(same, name).otherwise(F.raise_error(F.concat(F.lit("frozen rule was modified: "), name)))
    listed = rules.agg(F.collect_list(F.struct(name.alias("condition_id"), "predicates", "target")).alias("r")).scalar()
    values = F.map_from_arrays(
        F.array(*[F.lit(f) for f in FEATURES]), F.array(*[finite(F.col(f)) for f in FEATURES])
    )
    tagged = samples.withColumn("_values", values).withColumn("_rule", F.explode(listed))
    found = F.transform(F.col("_rule.predicates"), lambda p: F.col("_values")[p["feature"]])
    # The language guarantees finite thresholds, so a non-NULL value decides each term.
    passes = F.forall(
        F.col("_rule.predicates"),
        lambda p: F.coalesce(
            F.when(p["operator"] == ">=", F.col("_values")[p["feature"]] >= p["threshold"]).otherwise(
                F.col("_values")[p["feature"]] <= p["threshold"]
            ),
            F.lit(False),
        ),
    )
    return tagged.select(
        *samples.columns,
        F.col("_rule.condition_id").alias("condition_id"),
        F.col("_rule.target").alias("target"),
        F.forall(found, lambda v: v.isNotNull()).alias("available"),
        passes.alias("matched"),
        found.alias("feature_values"),
    )


def occurrences(
    samples: DataFrame, rules: DataFrame, sampling: SamplePolicy, search: SearchPolicy, context: str | None = None
) -> DataFrame:
    """Every match on every session; unknown outcomes have a NULL ``success``. ``context`` as in :func:`evaluate_rules`.

    ``nonoverlapping`` is chosen from anchors alone, reserving horizon plus quote
    age after each kept anchor.
    """
    hits = evaluate_rules(with_partition(samples, search), rules, context).filter("matched")
    reserve = to_us(sampling.horizon_seconds + sampling.quote_max_age_seconds)
    hits = hits.withColumn("_until", F.col("anchor_us") + F.lit(reserve).cast("bigint")).withColumn(
        "success", F.when(F.col("label") != "UNKNOWN", F.col("label") == F.col("target"))
    )
    carry = [
        "sample_id", "partition", "start_us", "end_us", "condition_ns", "label", "point_change",
        "target", "success", "feature_values",
    ]
    return greedy_spacing(
        hits,
        by=["condition_id", "underlying", "trading_date"],
        start="anchor_us",
        end="_until",
        flag="nonoverlapping",
        carry=carry,
    ).drop("_until")


def _stats(prefix: str, when: Column) -> list[Column]:
    known = F.col("label") != "UNKNOWN"
    won = F.col("label") == F.col("target")
    return [
        F.count_if(when).alias(f"{prefix}matches"),
        F.count_if(when & known & won).alias(f"{prefix}successes"),
        F.count_if(when & known & ~won).alias(f"{prefix}failures"),
        F.count_if(when & ~known).alias(f"{prefix}unknown_outcomes"),
        F.count_if(when & known).alias(f"{prefix}known_outcomes"),
    ]


def rule_summaries(
    samples: DataFrame, rules: DataFrame, hits: DataFrame, search: SearchPolicy
) -> DataFrame:
    """Denominators and outcome statistics per (rule, partition), zero rows included."""
    tested = evaluate_rules(with_partition(samples, search), rules)
    keys = ["condition_id", "partition"]
    main = tested.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("all_anchors"),
        F.count_if("available").alias("feature_available"),
        F.count_if(~F.col("available")).alias("feature_unknown"),
        F.count_if(F.col("available") & ~F.col("matched")).alias("nonmatches"),
        *_stats("", F.col("matched")),
        *_stats("baseline_", F.col("available")),
    )
    spaced = hits.groupBy(*keys).agg(*_stats("nonoverlapping_", F.col("nonoverlapping")))
    # Every frozen rule (at most ``max_conditions``) has a row for both partitions.
    both = F.explode(F.array(F.lit("discovery"), F.lit("evaluation"))).alias("partition")
    grid = rules.select("condition_id").distinct().select("condition_id", both)
    out = grid.join(main, keys, "left").join(spaced, keys, "left")
    out = out.fillna(0, subset=[c for c in (*main.columns, *spaced.columns) if c not in keys])
    for prefix in ("", "nonoverlapping_", "baseline_"):
        out = out.withColumn(
            f"{prefix}event_rate", F.try_divide(f"{prefix}successes", f"{prefix}known_outcomes")
        )
    return out


def discovery_matches(samples: DataFrame, rules: DataFrame, search: SearchPolicy) -> DataFrame:
    """Positive training rows behind each frozen rule."""
    train = training_rows(samples, search)
    hit = evaluate_rules(train, rules).filter(F.col("matched") & (F.col("label") == F.col("target")))
    return hit.select("condition_id", "sample_id", "condition_ns", "start_us", "feature_values")
