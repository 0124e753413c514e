"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.llm import alignment, bestfit, hostrules, jaccard, merkle, mixing, packing, quality, secrets, sharding, shards, topk, toxicity
from tickevidence.llm.common import held_out, table
from tickevidence.session import stage_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """The vocabulary of the queries; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Domains of the mixing query and stage, as conditions on the labels, with their share of the tokens.
DOMAINS = {"good": 0.97, "toxic": 0.01, "poor": 0.02}


def domain_of_labels():
    poor, toxic = F.col("quality") == 0, F.col("toxic") == 1
    return F.when(toxic, "toxic").when(poor, "poor").when(F.col("quality") == 1, "good")


TOP_SQL = """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
             CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
      FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM s)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 5
"""


@_query("op1_bit_sliced_top_k", TOP_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


@_query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc_id").cast("long"), "n_assign", "n_access", "n_hex", "n_flow", "base_sha256", "spans")


@_query("op3_mix_to_targets")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    _, rates, soft = mixing.mix(table(spark, sf_dir, "documents"), labels, domain_of_labels(), DOMAINS, highest=4.0)
    mixed = mixing.with_copies(soft, rates)
    shares = [F.get("posterior", F.lit(i)).alias(f"p_{name}") for i, name in enumerate(DOMAINS)]
    return mixed.select("doc_id", "tokens", *shares, "rate", "copies")


@_query("op4_token_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = stage_table(shards.write_shards(docs, tokenizer(), end_id=2), "token-shards")
    buckets = shards.bucket_count(docs.count())
    index = stage_table(shards.build_index(shards.directory(files), buckets), "key-index")
    located = shards.lookup(shards.document_keys(docs), index, buckets)
    read = shards.records(files).join(shards.shard_starts(files), "shard")
    rows = located.join(read, ["shard", "offset"])
    start = (F.col("shard_start") + F.col("offset")).alias("start")
    return rows.select("doc_id", start, "n_tokens", "ids_crc32", "shard", "offset")


@_query("op5_ngram_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"), words=4, percent=85)


#: Categories of the chain, in order, as conditions on the labels.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


@_query("op6_toxicity_chain")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()), CATEGORIES)
    scores = toxicity.score(docs, chain, list(CATEGORIES))
    cut = chain.cuts[list(CATEGORIES).index("toxic")] if chain else 0.5
    return scores.withColumn("toxic", (F.col("p_toxic") >= cut).cast("int"))


@_query("op7_compression_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0)
    return scored.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "score", predicted.cast("int").alias("predicted"))


@_query("op8_two_pass_shuffle")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = sharding.with_slots(sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), shards=8))
    return written.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "bucket")


RULES_SQL = r"""
WITH t AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, CASE WHEN trim(text, e' \t\n\x0b\x0c\r') = '' THEN []
                     ELSE regexp_split_to_array(trim(text, e' \t\n\x0b\x0c\r'), '[\x20\x09-\x0D]+') END AS words,
             list_filter(string_split(text, e'\n'), lambda x: trim(x, e' \t\n\x0b\x0c\r') <> '') AS lines FROM t),
g AS (SELECT doc_id, host, text, words, lines,
             CASE WHEN len(words) < 3 THEN [] ELSE list_transform(range(1, len(words) - 1),
                  lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END AS tri, row_number() OVER () AS k FROM w),
e AS (SELECT k, unnest(tri) AS s, unnest(range(1, len(tri) + 1)) AS i FROM g),
d AS (SELECT k, i FROM (SELECT *, count(*) OVER (PARTITION BY k, s) AS c FROM e) WHERE c > 1),
c AS (SELECT k, CAST(sum(CASE WHEN p IS NULL THEN 3 ELSE least(3, i - p) END) AS BIGINT) AS n
      FROM (SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS p FROM d) GROUP BY k),
m AS (SELECT doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(translate(text, e' \t\n\x0b\x0c\r', '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             coalesce(c.n, 0) AS n_repeat_words FROM g LEFT JOIN c USING (k)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
j AS (SELECT *, NOT base_failed AND (100 * n_symbols > 20 * word_chars OR 100 * n_dup_lines > 30 * n_lines) AS soft_failed FROM b),
h AS (SELECT host, count(*) AS docs, CAST(sum(CASE WHEN base_failed OR soft_failed THEN 1 ELSE 0 END) AS BIGINT) AS failures FROM j GROUP BY host),
a AS (SELECT count(*) AS hosts, CAST(sum(docs) AS DOUBLE) AS n, CAST(sum(failures) AS DOUBLE) AS f,
             CAST(sum(CAST(round(failures * (CAST(failures AS DOUBLE) / docs), 6) AS DECIMAL(28, 6))) AS DOUBLE) AS sq FROM h),
v AS (SELECT f / n AS mean, round(greatest(0.0, round(sq / n - (f / n) * (f / n), 12)) - (f / n) * (1 - f / n) * hosts / n, 12) AS spread FROM a),
p AS (SELECT mean, CASE WHEN spread > 0 THEN least(1000.0, greatest(1.0, mean * (1 - mean) / spread - 1)) ELSE 1000.0 END AS weight FROM v),
r AS (SELECT host, round((failures + mean * weight) / (docs + weight), 6) AS host_rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_rate < 0.9 AND NOT (host_rate >= 0.5 AND soft_failed) AS kept, host_rate
FROM j JOIN r ON j.host IS NOT DISTINCT FROM r.host
"""


@_query("op9_host_rules", RULES_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hostrules.judge_documents(table(spark, sf_dir, "documents"), host="source")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "host_rate")


@_query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = stage_table(packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer(), end_id=0), "pieces")
    return packing.piece_digests(pieces)


MERKLE_SQL = """
WITH RECURSIVE t AS (SELECT doc_id, lang, source, n_chars, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small,
    CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS grp,
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)) AS codes FROM documents),
f AS (SELECT doc_id, grp, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
             coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(small) || ':' || small, '-') AS changed,
             xor(list_reduce(list_prepend(4294967295, codes), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                 lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 3 = 0 AS hit FROM t),
l AS (SELECT doc_id, grp, sha256(head || body) AS leaf, CASE WHEN hit THEN sha256(head || changed) END AS tampered FROM f),
o AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id, leaf) - 1 AS pos, row_number() OVER () AS k FROM l),
g AS (SELECT 0 AS level, grp, pos, leaf AS h, count(*) OVER (PARTITION BY grp) AS n FROM o
      UNION ALL SELECT level + 1, grp, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 7) // 8 FROM g WHERE n > 1 GROUP BY level, grp, pos // 8),
s AS (SELECT grp, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n, level AS height FROM g WHERE n = 1),
r AS (SELECT 0 AS level, pos, subroot AS h, n FROM s
      UNION ALL SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 7) // 8 FROM r WHERE n > 1 GROUP BY level, pos // 8),
a AS (SELECT grp, level, pos, h, n FROM g WHERE n > 1
      UNION ALL SELECT grp, s.height + r.level, r.pos, r.h, r.n FROM r, s WHERE r.n > 1),
w AS (SELECT o.k, o.doc_id, o.leaf, o.tampered, o.pos, o.grp, s.subroot, s.pos AS lang_pos, s.height FROM o JOIN s USING (grp)),
p AS (SELECT w.k, a.level, string_agg(a.h, '' ORDER BY a.pos) FILTER (a.pos < x) AS lft, string_agg(a.h, '' ORDER BY a.pos) FILTER (a.pos > x) AS rgt
      FROM (SELECT w.*, lv.level, CASE WHEN lv.level < height THEN pos // CAST(8 ** lv.level AS BIGINT) ELSE lang_pos // CAST(8 ** (lv.level - height) AS BIGINT) END AS x
            FROM w JOIN (SELECT DISTINCT grp, level FROM a) lv ON lv.grp = w.grp) w
      JOIN a ON a.grp = w.grp AND a.level = w.level AND a.pos // 8 = x // 8 GROUP BY w.k, a.level),
z AS (SELECT k, list(coalesce(lft, '') ORDER BY level) AS ls, list(coalesce(rgt, '') ORDER BY level) AS rs FROM p GROUP BY k),
e AS (SELECT w.doc_id, leaf, subroot, coalesce(tampered, leaf) AS start, coalesce(ls, []) AS ls, coalesce(rs, []) AS rs FROM w LEFT JOIN z USING (k)),
v AS (SELECT doc_id, leaf, subroot, (SELECT h FROM r WHERE n = 1) AS root,
             sha256(list_aggregate(list_prepend('', list_transform(range(1, len(ls) + 1), lambda i: ls[i] || rs[i])), 'string_agg', '')) AS proof_sha256,
             list_reduce(list_prepend(start, list_transform(range(1, len(ls) + 1), lambda i: CAST(i AS VARCHAR))),
                         lambda y, i: sha256(ls[CAST(i AS BIGINT)] || y || rs[CAST(i AS BIGINT)])) AS folded_root FROM e)
SELECT *, folded_root = root AS verified FROM v
"""

#: Columns of a leaf, in their order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


@_query("op11_merkle_manifest", MERKLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*LEAF)
    # Tampering, where 3 divides the crc32 of the id: the letters A-Z of the text in lower case.
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = merkle.row_digest([lower if c == "text" else F.col(c) for c in LEAF])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    extra = {"doc_id": F.col("doc_id").cast("long"), "tampered": F.when(hit, tampered)}
    found = merkle.all_proofs(merkle.manifest(docs, "lang", ["doc_id"], LEAF, extra), list(extra))
    folded = merkle.folded(F.coalesce("tampered", "digest"))
    rows = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", merkle.path_digest().alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


@_query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.score_links(alignment.align_in_blocks(docs, tokenizer(), tokenizer("piece_bpe_32k.model")))


@_query("op13_bulk_best_fit")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = bestfit.pack_whole(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1, window=4096)
    return bestfit.piece_digests(packed)
