"""The registered queries of this subpackage and the SQL of those that have one."""

from pyspark.sql import functions as F

from pairloom.llm import (
    ball_tree,
    bpe,
    grace_dedup,
    host_filter,
    language_mix,
    ngram_join,
    ngram_trie,
    pareto_mix,
    token_counts,
    transducer,
    turn_repair,
    whitening,
    wrappers,
)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; the package lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ngram_join_classes(spark, sf_dir):
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"))


URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def url_verdicts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return host_filter.judge_urls(pages, URL_RULES).drop("url", "bound")


_SHRINK_SQL = """
{level}_spread AS (
  SELECT CASE WHEN coalesce(sum(n - 1) FILTER (n > 0), 0) = 0 THEN 10.0
    WHEN sum(n * pow(good / n - rate, 2) / (rate * (1 - rate))) FILTER (n > 0) <= count(*) FILTER (n > 0)
      THEN 1000.0
    ELSE least(1000.0, greatest(1.0, sum(n - 1) FILTER (n > 0)
      / (sum(n * pow(good / n - rate, 2) / (rate * (1 - rate))) FILTER (n > 0)
         - count(*) FILTER (n > 0)) - 1)) END AS m
  FROM {level}),
{level}_post AS (
  SELECT l.*, good + m * rate AS a, n - good + m * (1 - rate) AS b FROM {level} l, {level}_spread)"""

URL_VERDICTS_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
ruled AS (
  SELECT *, '.' || host AS dotted,
    CASE WHEN ends_with(dotted, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN ends_with(dotted, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN ends_with(dotted, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN ends_with(dotted, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN ends_with(dotted, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
    CASE WHEN rule IN ('org/', 'com/fr/') THEN 1 WHEN rule IS NOT NULL THEN 0 END AS good
  FROM split),
hosts AS (
  SELECT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
         string_split(host, '.')[-1] AS suffix,
         count(good)::DOUBLE AS n, coalesce(sum(good), 0)::DOUBLE AS good
  FROM ruled GROUP BY host),
level_1 AS (
  SELECT suffix, sum(n) AS n, sum(good) AS good,
         (SELECT (coalesce(sum(good), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) FROM hosts) AS rate
  FROM hosts GROUP BY suffix),""" + _SHRINK_SQL.format(level="level_1") + """,
level_2 AS (
  SELECT suffix, domain, sum(h.n) AS n, sum(h.good) AS good, any_value(a / (a + b)) AS rate
  FROM hosts h JOIN level_1_post USING (suffix) GROUP BY suffix, domain),""" + _SHRINK_SQL.format(
    level="level_2") + """,
level_3 AS (
  SELECT h.host, h.n, h.good, a / (a + b) AS rate FROM hosts h JOIN level_2_post USING (domain)),""" + (
    _SHRINK_SQL.format(level="level_3")) + """
SELECT page_id, host, path, rule,
  CASE WHEN r.good = 1 THEN 'allow' WHEN r.good = 0 THEN 'block'
       WHEN a / (a + b) - sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) >= 0.5 THEN 'allow'
       ELSE 'block' END AS verdict
FROM ruled r JOIN level_3_post USING (host)
"""


def bpe_round_trip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, vocabulary("word_bpe_49k.json"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def exact_dedup(spark, sf_dir):
    return grace_dedup.copy_groups(table(spark, sf_dir, "documents"))


EXACT_DEDUP_SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER best = 1 AS kept,
       sha256(content) AS text_sha256
FROM texts
WINDOW best AS (PARTITION BY content ORDER BY chars DESC, doc_id NULLS LAST)
"""


def source_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return pareto_mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


SOURCE_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (('0x' || md5('mix-' || coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))))[1:13])::UBIGINT
           ::DOUBLE + 0.5) / pow(2.0, 52) AS u
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 3.0 * source_size / weight AS full_at,
         (SELECT sum(source_size) FROM sources)
           - coalesce(sum(3.0 * source_size) OVER before, 0.0) AS left_over,
         sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM sources
  WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT left_over::DOUBLE / open_weight AS level FROM filled
  WHERE left_over / open_weight <= full_at ORDER BY full_at, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(3.0 * source_size::DOUBLE, level * weight) AS target
  FROM sources, level),
rates AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, floor(least(3.0, rate)) AS whole,
         CASE WHEN rate > floor(rate) THEN
           u / (1 - u) / ((rate - floor(rate)) / (1 - (rate - floor(rate)))) END AS odds
  FROM rates),
steps AS (
  SELECT source, odds, max(target) - any_value(w.certain) AS need, sum(size) AS words
  FROM ranked JOIN (SELECT source AS s2, sum(whole * size) AS certain FROM ranked GROUP BY 1) w
    ON source IS NOT DISTINCT FROM w.s2
  WHERE odds IS NOT NULL GROUP BY source, odds),
running AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY odds) AS upto FROM steps),
cuts AS (
  SELECT source AS s3, max(odds) AS cut FROM running
  WHERE upto - need < need - (upto - words) GROUP BY source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN odds <= cut THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked LEFT JOIN cuts ON source IS NOT DISTINCT FROM s3
"""


def page_texts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return wrappers.main_texts(pages).drop("html")


def top_vectors(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ball_tree.top_products(vectors, F.col("vec_id") % 50 == 0)


TOP_VECTORS_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""


def languages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_mix.identify_languages(docs).select("doc_id", "held_out", "lang_pred", "score")


def token_lengths(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json"))
    return counted.drop("text")


def lm_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_trie.score_held_out(docs).drop("text")


def byte_bpe_round_trip(spark, sf_dir):
    from public_tokenizers import PATTERN

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = transducer.round_trip(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def whitened_vectors(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors).drop("at")


def repaired_conversations(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.repair_damaged(turns)


QUERIES = {
    "op1_ngram_join": ngram_join_classes,
    "op2_url_filter": url_verdicts,
    "op3_bpe": bpe_round_trip,
    "op4_exact_dedup": exact_dedup,
    "op5_page_texts": page_texts,
    "op6_top_vectors": top_vectors,
    "op7_languages": languages,
    "op8_token_counts": token_lengths,
    "op9_source_mix": source_mix,
    "op10_lm_scores": lm_scores,
    "op11_byte_bpe": byte_bpe_round_trip,
    "op12_whitening": whitened_vectors,
    "op13_turn_repair": repaired_conversations,
}

ORACLE_SQL = {
    "op2_url_filter": URL_VERDICTS_SQL,
    "op4_exact_dedup": EXACT_DEDUP_SQL,
    "op6_top_vectors": TOP_VECTORS_SQL,
    "op9_source_mix": SOURCE_MIX_SQL,
}
