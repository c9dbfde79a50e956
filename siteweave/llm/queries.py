"""The operators as named queries over the test tables, each with its SQL where SQL can state it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from ..sources.tables import read_table
from . import (
    alignment,
    columnwise,
    dartminhash,
    licenses,
    mixing,
    packing,
    pivots,
    ranked,
    substrings,
    toxicity,
    url_rules,
    vafile,
    warc,
)
from .common import prepare

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op1_warc",
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS payload FROM pages),
    d AS (
      SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest
      FROM p),
    f AS (
      SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN first_id IS NULL OR first_id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
    FROM d LEFT JOIN f USING (payload_digest)
    """,
)
def op1_warc(spark, folder):
    records = warc.archive_round_trip(read_table(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# The rules of the query (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    "op2_url_filter",
    r"""
    WITH parts AS (
      SELECT page_id, url,
             translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
      FROM pages),
    rules(on_host, on_path, verdict) AS (VALUES
      ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
      ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    hits AS (
      SELECT host, path, on_host || on_path AS rule, verdict,
             row_number() OVER (PARTITION BY host, path ORDER BY length(on_host || on_path) DESC, length(on_host) DESC) AS place
      FROM (SELECT DISTINCT host, path FROM parts)
      JOIN rules ON (host = on_host OR ends_with(host, '.' || on_host)) AND starts_with(path, on_path))
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM parts LEFT JOIN (SELECT * FROM hits WHERE place = 1) USING (host, path)
    """,
)
def op2_url_filter(spark, folder):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.filter_urls(read_table(spark, folder, "pages"), rules)


@query("op3_packing")
def op3_packing(spark, folder):
    return packing.packed_documents(read_table(spark, folder, "documents"), packing.tokenizer_path())


@query("op4_mixing")
def op4_mixing(spark, folder):
    mixed = mixing.mix_documents(read_table(spark, folder, "documents"))
    taken = (F.col("size") * F.col("times")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


@query("op5_licenses")
def op5_licenses(spark, folder):
    found = licenses.scan_licenses(read_table(spark, folder, "documents"))
    base = F.filter("matches", lambda m: m["kind"] == "phrase")
    named = lambda matches: F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")
    starts = F.transform("base", lambda m: m["start"])
    return found.withColumn("base", base).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        named("base").alias("base_labels"),
        named("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"),
    )


@query(
    "op6_vafile",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 20 = 0 AND len(q.v) = len(c.v))
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM s QUALIFY rank <= 20
    """,
)
def op6_vafile(spark, folder):
    return vafile.exact_top_k(read_table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20, repeats=True)


@query("op7_minhash")
def op7_minhash(spark, folder):
    classes = dartminhash.near_duplicate_classes(read_table(spark, folder, "documents"))
    return classes.select("doc_id", "component_id", "class_size", "kept")


@query("op8_toxicity")
def op8_toxicity(spark, folder):
    docs = read_table(spark, folder, "documents")
    learnt = toxicity.in_training()
    model = toxicity.fit(docs, read_table(spark, folder, "labels"), learnt)
    scored = toxicity.score_toxicity(docs, model, ["doc_id"])
    held_out = F.coalesce(~learnt, F.lit(True)).alias("held_out")
    return scored.select("doc_id", held_out, "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query(
    "op9_substrings",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
      FROM documents),
    w AS (
      SELECT r, s, md5(array_to_string(words[s:s + 34], ' ')) AS h
      FROM (SELECT r, words, unnest(generate_series(1, len(words) - 34)) AS s FROM d WHERE len(words) >= 35)),
    again AS (
      SELECT r, s FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
    gone AS (
      SELECT DISTINCT r, i FROM (SELECT r, unnest(generate_series(s, s + 34)) AS i FROM again)),
    u AS (
      SELECT r, doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS i FROM d),
    kept AS (
      SELECT u.r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t
      FROM u ANTI JOIN gone ON u.r = gone.r AND u.i = gone.i GROUP BY 1)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)
    """,
)
def op9_substrings(spark, folder):
    cut = substrings.remove_repeats(read_table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    "op10_pivots",
    """
    WITH RECURSIVE usable AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
      SELECT a.vec_id AS a, b.vec_id AS b
      FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_dot_product(a.v, b.v)
            / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98),
    reach(a, b) AS (
      SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (
      SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    counts AS (
      SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
    """,
)
def op10_pivots(spark, folder):
    return pivots.near_duplicates(read_table(spark, folder, "embeddings"))


@query("op11_alignment")
def op11_alignment(spark, folder):
    docs = read_table(spark, folder, "documents")
    digest = lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256))
    return alignment.align_documents(docs, *alignment.tokenizer_paths(), groups=digest).withColumnRenamed("groups", "groups_sha256")


@query(
    "op12_columnwise",
    """
    WITH d AS (
      SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS o, doc_id, hex(encode(coalesce(text, ''))) AS t,
             strlen(coalesce(text, '')) AS n
      FROM documents),
    w AS (
      SELECT r, o, s, md5(substring(t, CAST(2 * s + 1 AS INTEGER), 200)) AS h
      FROM (SELECT r, o, t, unnest(generate_series(0, n - 100)) AS s FROM d WHERE n >= 100)),
    again AS (
      SELECT r, s FROM w JOIN (
        SELECT h, min(struct_pack(o := o, s := s)) AS f FROM w GROUP BY h HAVING count(*) > 1) USING (h)
      WHERE struct_pack(o := o, s := s) > f),
    runs AS (
      SELECT r, min(s) AS a, max(s) + 100 AS b FROM (
        SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS run FROM (
          SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 100 THEN 0 ELSE 1 END AS fresh FROM again))
      GROUP BY r, run),
    gaps AS (
      SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM runs
      UNION ALL SELECT d.r, max(b), any_value(n) FROM d JOIN runs ON runs.r = d.r GROUP BY d.r
      UNION ALL SELECT r, 0, n FROM d WHERE r NOT IN (SELECT r FROM runs)),
    kept AS (
      SELECT r, string_agg(substring(t, CAST(2 * a + 1 AS INTEGER), CAST(2 * (b - a) AS INTEGER)), '' ORDER BY a) AS k
      FROM gaps JOIN d USING (r) GROUP BY r)
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n - length(k) // 2 AS BIGINT) AS n_removed,
           (SELECT count(*) FROM runs WHERE runs.r = d.r) AS n_spans, sha256(unhex(k)) AS kept_sha256
    FROM d JOIN kept USING (r)
    """,
)
def op12_columnwise(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    cut = columnwise.remove_repeated_strings(docs)
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op13_ranked",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
      FROM documents),
    b AS (
      SELECT row_number() OVER () AS i, item_id,
             unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark),
    s AS (
      SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
    p AS (
      SELECT r, term, CAST(count(*) AS BIGINT) AS tf
      FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM b) GROUP BY ALL),
    w AS (
      SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM p, s GROUP BY term, n_docs),
    c AS (
      SELECT p.r, d.doc_id, p.term,
             w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * CAST(len(terms) AS BIGINT) * n_docs) // n_terms))) AS c
      FROM p JOIN w USING (term) JOIN d ON d.r = p.r, s),
    t AS (
      SELECT i, item_id, r, doc_id, CAST(sum(c) AS BIGINT) AS score
      FROM (SELECT i, item_id, term FROM b) JOIN c USING (term) GROUP BY ALL)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM t WHERE score > 0 QUALIFY rank <= 10
    """,
)
def op13_ranked(spark, folder):
    return ranked.rank_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)
