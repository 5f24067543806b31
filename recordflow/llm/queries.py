"""Registered queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (fertility, fmindex, geometric, hadamard, kernel_quality, language, linetree, minhash, packing, rans,
               token_counts, urlfilter, warc)
from .common import table
from .tokens import vocabulary


def op1_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op2_mixture_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_warc_archives(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_tokenizer_fertility(spark, sf_dir):
    return fertility.fertility(table(spark, sf_dir, "documents"))


def op5_bloom_url_filter(spark, sf_dir):
    """No block list is among the tables: the URLs of pages whose id is divisible by 20 count as listed."""
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, pages.where("page_id % 20 = 0"))


def op6_kernel_quality(spark, sf_dir):
    return kernel_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_rans_token_ids(spark, sf_dir):
    return rans.ids_round_trip(table(spark, sf_dir, "documents"))


def op8_fm_decontamination(spark, sf_dir):
    return fmindex.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_template_line_dedup(spark, sf_dir):
    docs = linetree.drop_recurring_lines(table(spark, sf_dir, "documents"), counts=True)
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op10_bigru_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


def op11_hadamard_clusters(spark, sf_dir):
    return hadamard.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, seed="3")


def op12_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op13_geometric_search(spark, sf_dir):
    return geometric.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_mixture_packing": op2_mixture_packing,
    "op3_warc_archives": op3_warc_archives,
    "op4_tokenizer_fertility": op4_tokenizer_fertility,
    "op5_bloom_url_filter": op5_bloom_url_filter,
    "op6_kernel_quality": op6_kernel_quality,
    "op7_rans_token_ids": op7_rans_token_ids,
    "op8_fm_decontamination": op8_fm_decontamination,
    "op9_template_line_dedup": op9_template_line_dedup,
    "op10_bigru_language": op10_bigru_language,
    "op11_hadamard_clusters": op11_hadamard_clusters,
    "op12_token_counts": op12_token_counts,
    "op13_geometric_search": op13_geometric_search,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {
    "op3_warc_archives": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        d AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
               CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM p LEFT JOIN d ON p.payload_digest = d.payload_digest""",
    "op5_bloom_url_filter": f"""
        WITH u AS (SELECT page_id, url, coalesce(instr(url, '://') > 0, false) AS has,
                          translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host,
                          regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
                          list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '^.*?://[^?#]*\\?([^#]*)', 1, 's'), '&'),
                              lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|gclid|fbclid|ref|sessionid)(=.*)?$'))) AS params
                   FROM pages),
        c AS (SELECT page_id, host, path, CASE WHEN has THEN regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/+$', '')
                  || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS canon FROM u),
        l AS (SELECT DISTINCT canon FROM c WHERE page_id % 20 = 0 AND canon IS NOT NULL),
        r AS (SELECT c.*, l.canon IS NOT NULL AS listed,
                     CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                          WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
                          WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                          WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
                          WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
              FROM c LEFT JOIN l ON c.canon = l.canon)
        SELECT page_id, host, path, rule, listed,
               CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL OR listed THEN 'block' ELSE 'allow' END AS verdict
        FROM r""",
}

# Rounds of exact k-means, one pair of common table expressions each.
_FIRST = """
    kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                          FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('3:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT 8))"""


def _assigned(n: int) -> str:
    return f"""
    a{n} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min_by(c, d * 8 + c) AS c, min(d) AS d FROM (
        SELECT k.r, k.vec_id, k.v, c.c, list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept k, c{n} c) GROUP BY r)"""


def _means(n: int) -> str:
    return f"""
    c{n + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{n} o LEFT JOIN (
        SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM (
            SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{n}) GROUP BY c, j) GROUP BY c) m ON m.c = o.c)"""


ORACLE["op11_hadamard_clusters"] = "WITH " + ",".join([_FIRST, *(f(n) for n in range(10) for f in (_assigned, _means)), _assigned(10)]) + """
    SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
           CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a10 a JOIN c10 c ON a.c = c.c"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE["op13_geometric_search"] = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS w FROM documents),
    q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS t FROM benchmark),
    s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d),
    p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
    v AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS wt FROM p, s GROUP BY t, nn),
    x AS (SELECT q.item_id, p.r, sum(wt * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(w) * nn) // ll)))) AS score
          FROM q JOIN p ON p.t = q.t JOIN v ON v.t = q.t JOIN d ON d.r = p.r, s GROUP BY q.item_id, p.r)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM (
        SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x JOIN d ON d.r = x.r WHERE score > 0)
    WHERE rank <= 10"""
