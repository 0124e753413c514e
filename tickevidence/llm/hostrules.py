"""Quality rules per document, and verdicts on their hosts. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickevidence.llm.common import SPACE, text_or_empty
from tickevidence.session import stage_table

#: Parameters of the verdict; rates are failures per document of a host.
RULES = {
    "min_words": 50,
    "max_repeat_percent": 50,
    "max_symbol_percent": 20,
    "max_dup_line_percent": 30,
    "strict_rate": 0.5,
    "closed_rate": 0.9,
}
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The words of a text; an empty array when it has none."""
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def _repeat_words(shingles: Column) -> Column:
    """Words in 3-word windows that occur twice or more.

    Windows are hashed (64 bits) and sorted with their places; neighbours with equal
    hashes are repeats. Each repeated window adds the words since the previous one, at
    most three. Texts without any repeated window stop after the distinct count.
    """
    placed = F.array_sort(F.transform(shingles, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeats(rows: Column) -> Column:
        def same(x: Column, i: Column) -> Column:
            before = F.get(rows, i - 1)
            after = F.get(rows, i + 1)
            return F.coalesce(before["h"] == x["h"], F.lit(False)) | F.coalesce(after["h"] == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(rows, same), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.when(i == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(at, i - 1))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    # One-element arrays bind an intermediate value, so it is computed once.
    bound = F.transform(F.array(placed), lambda rows: covered_of(repeats(rows), covered))
    found = F.get(bound, F.lit(0))
    return F.when(F.size(F.array_distinct(shingles)) == F.size(shingles), F.lit(0).cast("long")).otherwise(found)


def covered_of(at: Column, covered) -> Column:
    return F.get(F.transform(F.array(at), covered), F.lit(0))


def rule_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the counts of every whole text; one scan, no shuffle.

    n_words, word_chars (code points in words), n_symbols, n_lines (with a word),
    n_dup_lines and n_repeat_words. A NULL text has no words. NULL hosts are one host.
    """
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"), text.alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    # Widening the words by their next two keeps each window one hash of three values.
    shingles = F.when(F.size("words") < 3, F.array().cast("array<long>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        )
    )
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    rows = rows.withColumns({"shingles": shingles, "lines": lines})
    return rows.select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", _BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("shingles")).alias("n_repeat_words"),
    )


def with_rules(counts: DataFrame, rules: dict = RULES) -> DataFrame:
    """Adds base_failed, and soft_failed: signs that count only on a host under suspicion."""
    base = (F.col("n_words") < rules["min_words"]) | (
        100 * F.col("n_repeat_words") > rules["max_repeat_percent"] * F.col("n_words")
    )
    soft = (100 * F.col("n_symbols") > rules["max_symbol_percent"] * F.col("word_chars")) | (
        100 * F.col("n_dup_lines") > rules["max_dup_line_percent"] * F.col("n_lines")
    )
    return counts.withColumns({"base_failed": base, "soft_failed": ~base & soft})


def host_verdicts(judged: DataFrame, rules: dict = RULES) -> DataFrame:
    """One row per host: documents, failures, shrunk rate and verdict (open, strict, closed).

    A failure is a base or soft failure. The beta prior is empirical: mean and
    variance of the hosts' rates, weighted by documents, set its two parameters by
    moments, so a host with few documents is drawn to the corpus rate. Sums are
    taken over integers or rounded to 12 digits, so the order of rows has no effect.
    Without spread between hosts (or with one host) the prior holds 1,000 documents.
    """
    failed = (F.col("base_failed") | F.col("soft_failed")).cast("long")
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("docs"), F.sum(failed).alias("failures"))
    rate = F.col("failures") / F.col("docs")
    total = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("docs").alias("all_docs"),
        F.sum("failures").alias("all_failures"),
        F.sum(F.round(F.col("failures") * rate, 6).cast("decimal(28,6)")).alias("squares"),
    )
    mean = F.col("all_failures") / F.col("all_docs")
    var = F.greatest(F.lit(0.0), F.round(F.col("squares").cast("double") / F.col("all_docs") - mean * mean, 12))
    # What chance alone adds to the variance of the rates, with that many documents a host.
    chance = mean * (1 - mean) * F.col("hosts") / F.col("all_docs")
    spread = F.greatest(F.lit(0.0), F.round(var - chance, 12))
    weight = F.when(spread > 0, F.least(F.lit(1000.0), F.greatest(F.lit(1.0), mean * (1 - mean) / spread - 1))).otherwise(1000.0)
    # The prior is one row of two numbers; NULL for an empty table, which has no hosts either.
    prior = total.select((mean * weight).alias("alpha"), weight.alias("weight")).first()
    shrunk = F.round((F.col("failures") + F.lit(prior["alpha"])) / (F.col("docs") + F.lit(prior["weight"])), 6)
    verdict = (
        F.when(F.col("host_rate") >= rules["closed_rate"], "closed")
        .when(F.col("host_rate") >= rules["strict_rate"], "strict")
        .otherwise("open")
    )
    return (
        hosts.withColumn("host_rate", shrunk)
        .withColumn("verdict", verdict)
        .select("host", "docs", "failures", "host_rate", "verdict")
    )


def judge_documents(docs: DataFrame, host: str = "source", rules: dict = RULES) -> DataFrame:
    """Counts, failures, host verdict and kept flag of every document.

    Kept: no base failure, the host is not closed, and on a strict host no soft
    failure either. The texts are scanned once, into a staged table of counts. Hosts are aggregated before their shuffle and come back through a
    join, whose large side AQE may split; a host with a third of all rows is no hot group.
    """
    judged = with_rules(stage_table(rule_counts(docs, host), "rule-counts"), rules)
    hosts = host_verdicts(judged, rules)
    back = judged.join(hosts.select(F.col("host").alias("_host"), "host_rate", "verdict"), F.col("host").eqNullSafe(F.col("_host")))
    kept = ~F.col("base_failed") & (F.col("verdict") != "closed") & ~((F.col("verdict") == "strict") & F.col("soft_failed"))
    return back.drop("_host").withColumn("kept", kept)
