"""Independent audit of a research run: thirteen checks, PASS, FAIL or INSUFFICIENT_DATA.

Two checks replay the producers; the others recompute from the source rows named
in the lineage, by plain key joins instead of the producers' windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickevidence.functions.clock import to_us, us
from tickevidence.operators import rules as R
from tickevidence.operators import sampling as S
from tickevidence.operators.joins import compare_tables

SAMPLE_VALUES = (
    "underlying", "trading_date", "anchor_us", "condition_ns", "start_us", "end_us", "start_spot", "end_spot",
    "point_change", "label", "outcome_status", "outcome_reason", "start_observation_ids", "end_observation_ids", *S.FEATURES,
)


@dataclass(frozen=True)
class Run:
    """Everything a run stored, and the source it claims to come from."""

    tape: DataFrame
    samples: DataFrame
    search_log: DataFrame
    rules: DataFrame
    hits: DataFrame
    summaries: DataFrame
    sampling: S.SamplePolicy
    search: R.SearchPolicy
    dataset_id: str


def _row(name: str, df: DataFrame, bad: Column | None = None) -> DataFrame:
    count = F.count(F.lit(1)) if bad is None else F.count_if(F.coalesce(bad, F.lit(True)))
    return df.agg(count.alias("violations")).select(F.lit(name).alias("check"), "violations")


def _repeated(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(key).isNull())


def lineage_sources(samples: DataFrame, tape: DataFrame) -> DataFrame:
    """One row per (sample, feature, source id) with the source's own values."""
    listed = samples.select(
        "sample_id", "underlying", "start_us", "condition_ns", F.explode("feature_lineage").alias("feature", "claim")
    )
    each = listed.select("*", F.explode("claim.observation_ids").alias("observation_id"))
    source = tape.select(
        "observation_id", F.col("underlying").alias("_underlying"), us("timestamps").alias("_at"), "optiontype", "contract_key",
        "spot", "bid", "ask", "oi", "volume", "iv", "delta", "gamma", "theta", "vega",
        us("iv_available_at").alias("_iv_at"), us("greeks_available_at").alias("_greeks_at"),
    )
    return each.join(source, "observation_id", "left")


def _feature_checks(run: Run) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Availability, lineage and arithmetic violations per stored feature value."""
    rows = lineage_sources(run.samples, run.tape)
    c = F.col
    kind = F.regexp_replace("feature", "^(CE|PE)_", "")
    side = F.regexp_extract("feature", "^(CE|PE)_", 1)
    own_at = (
        F.when(kind == "iv_decimal", c("_iv_at"))
        .when(kind.isin("delta", "gamma", "theta", "vega"), c("_greeks_at"))
        .otherwise(c("_at"))
    )
    mid = S.midpoint(c("bid"), c("ask"))
    tagged = rows.withColumns({"_kind": kind, "_side": side, "_own": own_at, "_mid": mid})
    old = {n: F.min_by(c(n), c("_at")) for n in ("spot", "_mid", "oi", "volume")}
    new = {n: F.max_by(c(n), c("_at")) for n in ("spot", "_mid", "oi", "volume", "bid", "ask", "iv", "delta", "gamma", "theta", "vega")}
    grouped = tagged.groupBy("sample_id", "feature", "_kind", "condition_ns").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("_at").alias("found"),
        F.countDistinct("_at").alias("times"),
        F.max("_own").alias("available"),
        F.max("claim.max_available_us").alias("claimed"),
        F.max("_at").alias("newest"),
        F.count_if((c("_side") != "") & (c("_side") != c("optiontype"))).alias("wrong_side"),
        F.count_if(c("underlying") != c("_underlying")).alias("wrong_underlying"),
        F.countDistinct(F.when(c("_side") != "", c("contract_key"))).alias("contracts"),
        *[v.alias(f"old_{k}") for k, v in old.items()],
        *[v.alias(f"new_{k}") for k, v in new.items()],
    )
    late = (
        ~(c("available") == c("claimed"))
        | (c("available") * 1000 > c("condition_ns"))
        | (c("newest") * 1000 > c("condition_ns"))
    )
    broken = (c("found") < c("n")) | (c("wrong_side") > 0) | (c("wrong_underlying") > 0) | (c("contracts") > 1)
    expected = (
        F.when(c("_kind") == "past_spot_change", c("new_spot") - c("old_spot"))
        .when(c("_kind") == "past_midpoint_return_pct", S.pct_change(c("new__mid"), c("old__mid")))
        .when(c("_kind") == "past_oi_change_pct", S.pct_change(c("new_oi"), c("old_oi")))
        .when(c("_kind") == "past_volume_increment", (c("new_volume") - c("old_volume")).cast("double"))
        .when(c("_kind") == "spread_pct", F.when(c("new__mid") > 0, 100 * (c("new_ask") - c("new_bid")) / c("new__mid")))
        .when(c("_kind") == "iv_decimal", c("new_iv"))
        .otherwise(
            F.coalesce(*[F.when(c("_kind") == g, c(f"new_{g}")) for g in ("delta", "gamma", "theta", "vega")])
        )
    )
    stored = run.samples.select(
        "sample_id",
        F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in S.FEATURES])),
    ).filter("value is not null")
    matched = stored.join(grouped.withColumn("expected", expected), ["sample_id", "feature"], "full_outer")
    close = F.abs(c("value") - c("expected")) <= F.greatest(
        F.lit(1e-9), 1e-9 * F.greatest(F.abs(c("value")), F.abs(c("expected")))
    )
    return (
        _row("actual_feature_availability_before_condition", grouped, late),
        _row("source_lineage_and_contract_continuity", grouped, broken),
        _row("independent_source_feature_arithmetic", matched, ~F.coalesce(close, F.lit(False))),
    )


def _event_check(run: Run) -> DataFrame:
    """Start and end prices from the named source rows, and the label from their difference."""
    source = run.tape.select("observation_id", "spot", us("timestamps").alias("_at"))
    ends = run.samples.select(
        "sample_id",
        F.inline(
            F.array(
                F.struct(F.lit("s").alias("role"), F.col("start_observation_ids").alias("ids"), F.col("start_us").alias("at"), F.col("start_spot").alias("price")),
                F.struct(F.lit("e").alias("role"), F.col("end_observation_ids").alias("ids"), F.col("end_us").alias("at"), F.col("end_spot").alias("price")),
            )
        ),
    ).select("sample_id", "role", "at", "price", F.explode("ids").alias("observation_id"))
    joined = ends.join(source, "observation_id", "left")
    wrong = ~((F.col("at") == F.col("_at")) & (F.col("price") == F.col("spot")))
    prices = joined.agg(F.count_if(F.coalesce(wrong, F.lit(True))).alias("a"))
    c = F.col
    change = F.when(c("outcome_reason") == "complete", c("end_spot") - c("start_spot"))
    bad = (
        ~change.eqNullSafe(c("point_change"))
        | (S.classify_move(c("point_change"), run.sampling) != c("label"))
        | ((c("outcome_status") == "COMPLETE") != (c("outcome_reason") == "complete"))
        | (c("start_us") > c("anchor_us"))
        | (c("anchor_us") - c("start_us") > to_us(run.sampling.quote_max_age_seconds))
    )
    labels = run.samples.agg(F.count_if(F.coalesce(bad, F.lit(True))).alias("b")).scalar()
    return prices.select(
        F.lit("independent_source_event_checks").alias("check"), (F.col("a") + labels).alias("violations")
    )


def _occurrence_check(run: Run) -> DataFrame:
    """Matches recomputed with literal predicates, and spacing from its definition.

    A kept hit starts at or after the reserve of the last kept hit before it, and
    a rejected one does not; that property alone fixes the greedy choice.
    """
    frozen = run.rules.select("condition_id", "predicates", "target").collect()  # at most max_conditions rows
    expected = None
    tagged = R.with_partition(run.samples, run.search)
    for rule in frozen:
        _, matched = R.predicate_column([p.asDict() for p in rule["predicates"]])
        mine = tagged.filter(matched).select(
            F.lit(rule["condition_id"]).alias("condition_id"),
            "sample_id",
            "partition",
            "label",
            "point_change",
            F.when(F.col("label") != "UNKNOWN", F.col("label") == rule["target"]).alias("success"),
        )
        expected = mine if expected is None else expected.unionByName(mine)
    if expected is None:
        return _row("exact_occurrence_set_and_values", run.hits)
    stored = run.hits.select(*expected.columns)
    differ = compare_tables(stored, expected, ["condition_id", "sample_id"]).agg(F.count(F.lit(1)).alias("a"))
    reserve = to_us(run.sampling.horizon_seconds + run.sampling.quote_max_age_seconds)
    order = W.partitionBy("condition_id", "underlying", "trading_date").orderBy("anchor_us").rowsBetween(
        W.unboundedPreceding, -1
    )
    last = F.max(F.when(F.col("nonoverlapping"), F.col("anchor_us"))).over(order)
    should = last.isNull() | (F.col("anchor_us") >= last + reserve)
    spaced = run.hits.select((should != F.col("nonoverlapping")).alias("bad"))
    wrong = spaced.agg(F.count_if(F.coalesce("bad", F.lit(True))).alias("b")).scalar()
    return differ.select(
        F.lit("exact_occurrence_set_and_values").alias("check"), (F.col("a") + wrong).alias("violations")
    )


def audit(run: Run) -> DataFrame:
    """(check, violations, passed) for the thirteen checks."""
    c = F.col
    context = R.rule_context(run.dataset_id, run.sampling, run.search)
    need = {"sample_id", "feature_lineage", *SAMPLE_VALUES}
    missing = len(need - set(run.samples.columns))
    schema = run.samples.sparkSession.range(1).select(
        F.lit("audit_input_schema").alias("check"), F.lit(missing).cast("bigint").alias("violations")
    )
    if missing:
        return schema.withColumn("passed", F.lit(False))
    identity = F.sha2(
        F.concat_ws("|", F.lit(run.dataset_id), "underlying", c("anchor_us").cast("string"), F.lit(S.policy_text(run.sampling))), 256
    )
    out = schema.unionByName(_row("artifacts_bound_to_run", run.samples, c("sample_id") != identity))
    unique = _repeated(run.samples, "sample_id").select("n").unionByName(_repeated(run.tape, "observation_id").select("n"))
    out = out.unionByName(_row("unique_source_and_sample_ids", unique))
    parts = R.partition_days(run.samples, run.search).select("trading_date", c("partition").alias("_part"))
    days = run.hits.join(F.broadcast(parts), "trading_date", "left")
    out = out.unionByName(
        _row("chronological_exhaustive_sessions", days, ~c("partition").eqNullSafe(c("_part")))
    )
    language = F.forall(
        "predicates",
        lambda p: p["feature"].isin(*S.FEATURES) & p["operator"].isin(*R.OPERATORS) & (F.abs(p["threshold"]) < float("inf")),
    )
    frozen = R.modified_rules(run.rules, context).select("condition_id").unionByName(
        run.rules.filter(~F.coalesce(language, F.lit(False))).select("condition_id")
    )
    out = out.unionByName(_row("conditions_frozen_and_bound_to_config", frozen))
    again = R.search_log(run.samples, run.sampling, run.search, run.dataset_id)
    flat = [x for x in again.columns if x != "predicates"]
    replay = compare_tables(run.search_log.select(*flat), again.select(*flat), ["condition_id"])
    chosen = R.top_rules(again, run.search.max_conditions).select("condition_id")
    unlike = chosen.join(run.rules, "condition_id", "left_anti").unionByName(
        run.rules.select("condition_id").join(chosen, "condition_id", "left_anti")
    )
    out = out.unionByName(
        _row("discovery_replay_consistency", replay.select("condition_id").unionByName(unlike.select("condition_id")))
    )
    cols = ["sample_id", *SAMPLE_VALUES]
    rebuilt = S.build_samples(run.tape, run.sampling, run.dataset_id).select(*cols)
    out = out.unionByName(
        _row("sampler_replay_consistency", compare_tables(run.samples.select(*cols), rebuilt, ["sample_id"]))
    )
    for part in _feature_checks(run):
        out = out.unionByName(part)
    out = out.unionByName(_event_check(run)).unionByName(_occurrence_check(run))
    summary = R.rule_summaries(run.samples, run.rules, run.hits, run.search)
    out = out.unionByName(
        _row(
            "exact_summary_set_and_denominators",
            compare_tables(run.summaries.select(*summary.columns), summary, ["condition_id", "partition"]),
        )
    )
    return out.withColumn("passed", c("violations") == 0)


def audit_status(checks: DataFrame, run: Run) -> DataFrame:
    """One row: PASS needs every check, rules, evaluation days and a known evaluation outcome."""
    known = run.summaries.filter("partition = 'evaluation'").agg(
        F.coalesce(F.sum("known_outcomes"), F.lit(0)).alias("k")
    ).scalar()
    rules = run.rules.agg(F.count(F.lit(1)).alias("r")).scalar()
    failed = checks.agg(F.count_if(~F.col("passed")).alias("failed"))
    return failed.withColumn("known_evaluation_outcomes", known).withColumn("rules", rules).withColumn(
        "status",
        F.when(F.col("failed") > 0, "FAIL")
        .when((F.col("rules") > 0) & (F.col("known_evaluation_outcomes") > 0), "PASS")
        .otherwise("INSUFFICIENT_DATA"),
    )
