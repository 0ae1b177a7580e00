"""The operators applied to their whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygauge.llm import alignment, bpe, hard_negatives, mixing, near_dup, pieces, ppm, quality
from daygauge.llm import recipes, run_index, sharding, token_counts, urls
from daygauge.llm.workspace import ship, stored

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    urls.rule("allow", "org/"),
    urls.rule("block", "example.org/es/"),
    urls.rule("block", "example.org/en/1"),
    urls.rule("allow", "com/fr/"),
    urls.rule("block", "com/de/"),
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scored(_documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(_documents(spark, sf_dir), path).withColumn("over_limit", F.col("n_tokens") > 1024)


def op3_run_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_index.repeated_spans(_documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(_documents(spark, sf_dir)).drop("times")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return urls.with_verdict(pages, rules=URL_RULES).select("page_id", "judged.*")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_documents(spark, sf_dir))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.sharded(_documents(spark, sf_dir), shards=16)
    return placed.selectExpr(
        "doc_id", "size", "text_crc32", "'rows' AS law", "shard", "slot", "CAST(NULL AS int) AS grown_shard"
    )


def bpe_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = bpe.encoded(docs.select("doc_id", "text"), path, text_out="decoded").drop("text")
    return texts.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) DIV 4 AS bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.exact_groups(_documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_documents(spark, sf_dir)).drop("n_lines")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    docs = _documents(spark, sf_dir).select(F.col("doc_id").cast("bigint"), F.col("text").alias("aligned"))
    made = alignment.aligned(docs, *paths, text="aligned", out="aligned")
    digest = F.when(F.col("aligned.groups") == "", "").otherwise(F.sha2("aligned.groups", 256))
    fields = [f"aligned.{c}" for c in ("n_a", "n_b", "n_groups", "n_links", "pairs", "times")]
    numbered = made.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", *fields, digest.alias("groups_sha256")
    )
    return alignment.with_counts(stored(numbered, "aligned"), "pairs", "times")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    noisy = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives.hard_negatives(rows.withColumn("label", noisy), F.col("vec_id") % 100 == 0)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _documents(spark, sf_dir).select("doc_id", F.col("text").alias("pieces"))
    made = pieces.encoded(docs, path, text="pieces", out="pieces", end=True, decode=True)
    return made.select(
        "doc_id",
        F.size("pieces.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("pieces.ids", " "), 256).alias("ids_sha256"),
        F.sha2("pieces.decoded", 256).alias("decoded_sha256"),
        F.array_max("pieces.ends").cast("bigint").alias("n_bytes"),
    )


def _shipped(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = [
        op1_lm_scoring,
        op2_token_counts,
        op3_run_index_dedup,
        op4_mixing,
        op5_url_filter,
        op6_minhash_dedup,
        op7_sharding,
        op8_bpe,
        op9_exact_dedup,
        op10_quality_rules,
        op11_token_alignment,
        op12_hard_negatives,
        op13_sentencepiece,
    ]
    return {query.__name__: _shipped(query) for query in found}


# --- SQL ----------------------------------------------------------------------

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT norm, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)"""

MIXING_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS}) AS size,
         CAST('0x' || substr(md5('mix ' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS place
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         ([{", ".join(map(str, mixing.WEIGHTS))}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, row_number() OVER w AS k,
         (SELECT sum(size) FROM d) * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER (
           w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open
  FROM s WINDOW w AS (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST)),
level AS (SELECT * FROM f WHERE rest * weight / open <= 2 * source_size ORDER BY k LIMIT 1),
goals AS (
  SELECT f.source, f.source_size,
         CASE WHEN f.k < coalesce((SELECT k FROM level), 1 << 60) THEN (2 * f.source_size)::DOUBLE
              ELSE (SELECT rest FROM level) * f.weight / (SELECT open FROM level) END AS target
  FROM f),
queue AS (
  SELECT doc_id, d.source, size, r.round, source_size, target,
         r.round * source_size + sum(size) OVER (
           PARTITION BY d.source, r.round ORDER BY place, CAST(doc_id AS VARCHAR), size)::BIGINT AS words
  FROM d JOIN goals ON d.source IS NOT DISTINCT FROM goals.source, range(2) r(round)),
timed AS (
  SELECT *, words / nullif(target, 0) AS finish FROM queue),
served AS (
  SELECT *, finish IS NOT NULL AND sum(size) OVER (ORDER BY finish, source NULLS LAST)
            <= 1.5 * (SELECT sum(size) FROM d) AS served
  FROM timed)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       CAST(sum(CASE WHEN served THEN size ELSE 0 END) AS BIGINT) AS taken
FROM served GROUP BY doc_id"""

_RULES = sorted(URL_RULES, key=lambda r: -len(r.name))


def _url_sql() -> str:
    def hits(terms) -> str:
        return " + ".join(
            f"CAST(regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])') AS BIGINT)" for term in terms
        )

    def first(value: str) -> str:
        cases = " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
            f"THEN '{getattr(r, value)}'"
            for r in _RULES
        )
        return f"CASE {cases} END"

    shape = "'(?s)^.*?://([^/?#]*)([^?#]*)'"
    return f"""
WITH u AS (
  SELECT page_id, {_LOWER.format("coalesce(url, '')")} AS low,
         {_LOWER.format(f"regexp_extract(coalesce(url, ''), {shape}, 1)")} AS host,
         regexp_extract(coalesce(url, ''), {shape}, 2) AS path
  FROM pages),
h AS (SELECT *, {hits(urls.STRICT)} AS n_strict, {hits(urls.SOFT)} AS n_soft FROM u)
SELECT page_id, host, path, {first("name")} AS rule,
       coalesce({first("verdict")},
                CASE WHEN n_strict > 0 OR n_soft >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict, n_soft
FROM h"""


def _quality_sql() -> str:
    width = f"ln({quality.WIDTH}::DOUBLE)"
    ratios = list(quality.RATIOS.items())
    each = "\n  UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS measure, CAST({part} AS DOUBLE) / nullif({whole}, 0) AS value, "
        f"{slack}::DOUBLE AS slack FROM b WHERE NOT base_failed"
        for name, (part, whole, slack) in ratios
    )
    bounds = ",\n         ".join(
        f"max(CASE WHEN measure = '{name}' THEN {bound} END) AS {bound}_{name}"
        for name, _ in ratios
        for bound in ("least", "most")
    )
    inside = " AND ".join(
        f"coalesce(CAST({part} AS DOUBLE) / nullif({whole}, 0) BETWEEN least_{name} AND most_{name}, true)"
        for name, (part, whole, _) in ratios
    )
    quantile = "pow({1}, min(bucket) FILTER (WHERE upto >= al * {0})) AS {2}"
    found = ", ".join(
        quantile.format(share, quality.WIDTH, name)
        for share, name in ((quality.LOWER, "lower_"), (quality.MIDDLE, "middle"), (quality.UPPER, "upper_"))
    )
    spread = f"measure = '{quality.SPREAD}'"
    return rf"""
WITH t AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS pos, words FROM t WHERE len(words) > 2),
windows AS (SELECT doc_id, pos, [words[pos], words[pos + 1], words[pos + 2]] AS win FROM w),
twice AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT pos + o) AS n FROM twice, range(3) offsets(o) GROUP BY doc_id),
m AS (
  SELECT t.doc_id, lang, source, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         coalesce(list_sum(list_transform(words, lambda w: CASE
           WHEN regexp_matches(w, '[^#*$%&|<>]') THEN length(w) - length(regexp_replace(w, '[#*$%&|<>]', '', 'g'))
           ELSE 0 END)), 0) AS {quality.GLUED}
  FROM t LEFT JOIN repeats USING (doc_id)),
b AS (
  SELECT *, n_words < {quality.MIN_WORDS}
            OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m),
v AS ({each}),
k AS (
  SELECT lang, source, measure, slack,
         CAST(CASE WHEN value < {quality.LEAST} THEN {quality.ZERO} ELSE ceil(ln(value) / {width}) END AS INT) AS bucket,
         count(*) AS n
  FROM v WHERE value IS NOT NULL GROUP BY ALL),
s AS (
  SELECT *, coalesce(sum(n) FILTER (WHERE bucket <> {quality.ZERO}) OVER (PARTITION BY lang, source, measure), 0)
            / sum(n) OVER (PARTITION BY lang, source, measure) AS share FROM k),
r AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY lang, source, measure) AS al FROM s WHERE bucket <> {quality.ZERO}),
q AS (SELECT lang, source, measure, slack, share, {found} FROM r GROUP BY lang, source, measure, slack, share),
e AS (
  SELECT *, CASE WHEN {spread} THEN middle - (middle - lower_) * {quality.REACH} - slack ELSE 0 END AS least,
         CASE WHEN {spread} THEN middle + (upper_ - middle) * {quality.REACH} + slack
              ELSE slack + {quality.HABIT_REACH} * share * share * upper_ END AS most FROM q),
bounds AS (
  SELECT lang, source, {bounds} FROM e GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {inside} AS kept
FROM b LEFT JOIN bounds ON b.lang IS NOT DISTINCT FROM bounds.lang AND b.source IS NOT DISTINCT FROM bounds.source"""


# Every anchor against every row, by plain inner products.
HARD_NEGATIVES_SQL = """
WITH own AS (
  SELECT row_number() OVER () AS row_no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row_no, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM own a JOIN own b ON a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id),
positives AS (
  SELECT row_no, anchor_id, other_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY row_no ORDER BY score DESC, other_id NULLS LAST) AS place
  FROM scored WHERE alike QUALIFY place <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY row_no, place ORDER BY n.score DESC, n.other_id NULLS LAST) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (row_no)
WHERE NOT n.alike AND 100 * n.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
QUALIFY rank <= 10"""


def oracle_sql() -> dict[str, str]:
    """No SQL for the ring of op7: its overflow goes round by round; tested against brute force."""
    return {
        "op4_mixing": MIXING_SQL,
        "op5_url_filter": _url_sql(),
        "op9_exact_dedup": EXACT_DEDUP_SQL,
        "op10_quality_rules": _quality_sql(),
        "op12_hard_negatives": HARD_NEGATIVES_SQL,
    }
