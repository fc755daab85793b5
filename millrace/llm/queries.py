"""Queries of the training-data operators over the given tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, bpe, centroids, chat, exactdedup, extract, licenses, mixing, piecebpe, quality, simhash, topk, urlrules
from millrace.llm.common import SCHEMAS, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


def vocabulary() -> tuple[str, str]:
    """Path of the byte-level vocabulary and its splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


@query()
def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


MIX_SQL = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(n) / (SELECT sum(sqrt(n)) FROM counts) * (SELECT sum(n) FROM counts) / n AS rate FROM counts
),
parts AS (SELECT source, rate, CAST(ceil(rate / 8) AS INTEGER) AS parts FROM rates),
cdf AS (
  SELECT source, rate, parts, k, sum(exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)))
    OVER (PARTITION BY source ORDER BY k) AS below
  FROM parts, range(0, 65) r(k)
),
named AS (
  SELECT doc_id, source, md5(concat(coalesce(CAST(doc_id AS VARCHAR), chr(1)), chr(31), coalesce(text, chr(1)), chr(31), coalesce(lang, chr(1)),
    chr(31), coalesce(source, chr(1)), chr(31), coalesce(CAST(n_chars AS VARCHAR), chr(1)))) AS name
  FROM documents
),
draws AS (
  SELECT d.doc_id, d.source, name, part,
    (CAST('0x' || substr(md5('42:' || name || ':' || part), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM named d JOIN parts USING (source), range(1, 1000) p(part) WHERE part <= parts
),
numbers AS (
  SELECT doc_id, name, part, (SELECT count(*) FROM cdf WHERE cdf.source = draws.source AND cdf.below < u) AS n FROM draws
),
totals AS (SELECT doc_id, name, CAST(sum(n) AS INTEGER) AS n_copies FROM numbers GROUP BY doc_id, name),
copies AS (SELECT doc_id, name, n_copies, unnest(range(0, n_copies)) AS copy FROM totals)
SELECT d.*, CAST(copy AS INTEGER) AS copy, n_copies, md5('42-order:' || name || ':' || copy) AS shuffle_key
FROM documents d JOIN copies USING (doc_id)
"""


@query(MIX_SQL)
def op5_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), detail=True).drop("rate")


@query()
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs.select("doc_id", "text"), model).select(
        "doc_id", quality.is_held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query(r"""
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
  sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
WINDOW w AS (PARTITION BY norm)
""")
def op9_exact_dedup(spark, sf_dir):
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query()
def op10_byte_bpe(spark, sf_dir):
    path, pattern = vocabulary()
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, pattern)


CHAT_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sizes AS (
  SELECT *, lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before, length(text) + length(text) - length(replace(replace(replace(text, '~', ''), '[', ''), '<', '')) + 4
    + CASE role WHEN 'system' THEN 5 WHEN 'user' THEN 6 WHEN 'assistant' THEN 7 END AS size FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars,
  CASE WHEN bool_and((before, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'))) THEN last(role ORDER BY turn, role, text) ELSE 'error' END AS state,
  bool_and((before, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'))) AND last(role ORDER BY turn, role, text) IN ('user', 'assistant') AS valid
FROM sizes GROUP BY conv_id
"""


@query(CHAT_SQL)
def op2_chat(spark, sf_dir):
    control = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], SCHEMAS["conversations"])
    chats = chat.read_back(chat.format_chats(table(spark, sf_dir, "conversations").unionByName(own)))
    lines = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned_text").cast("long").alias("loss_chars"),
        F.sha2("learned_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "state",
        "valid",
    )


@query()
def op3_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
""")
def op4_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query("""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), hits AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN hits USING (page_id)
""")
def op7_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf_dir, "pages"), rules)


@query()
def op8_html(spark, sf_dir):
    return extract.extract(table(spark, sf_dir, "pages"))


def piece_vocabulary() -> str:
    """Path of the piece vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query()
def op11_piece_bpe(spark, sf_dir):
    path = piece_vocabulary()
    return piecebpe.digests(piecebpe.decode(piecebpe.encode(table(spark, sf_dir, "documents"), path), path))


@query()
def op12_alignment(spark, sf_dir):
    path, pattern = vocabulary()
    aligned = alignment.align_tokenizers(table(spark, sf_dir, "documents"), path, pattern, piece_vocabulary())
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


def _centroid_sql(centroids: int = centroids.CENTROIDS, rounds: int = centroids.ROUNDS) -> str:
    """Rounds written out; a vector and a centroid are lists."""
    steps = [
        f"""
kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row_no, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), centres0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v AS centre FROM kept
  QUALIFY cluster < {centroids}
)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""
pairs{r} AS (
  SELECT row_no, vec_id, v, cluster,
    list_sum(list_transform(range(1, 65), lambda i: (v[i] - centre[i]) * (v[i] - centre[i]))) AS distance
  FROM kept, centres{r}
), near{r} AS MATERIALIZED (
  SELECT row_no, any_value(vec_id) AS vec_id, any_value(v) AS v, min(distance) AS distance,
    min_by(cluster, distance * {centroids} + cluster) AS cluster
  FROM pairs{r} GROUP BY row_no
)""")
        if r < rounds:
            steps.append(f"""
means{r} AS (
  SELECT cluster, list(mean ORDER BY i) AS centre FROM (
    SELECT cluster, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS mean
    FROM near{r}, range(1, 65) c(i) GROUP BY cluster, i
  ) GROUP BY cluster
), centres{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(means{r}.centre, centres{r}.centre) AS centre FROM centres{r} LEFT JOIN means{r} USING (cluster)
)""")
    return f"""WITH {",".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(centre, ',')) AS centroid_sha256
FROM near{rounds} JOIN centres{rounds} USING (cluster)
"""


@query(_centroid_sql())
def op13_centroids(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))
