"""The operators of this package as queries over the test tables, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import (
    bpe, context_mixing, embeddings, exact_dedup, filter_audit, language, lexical, licenses, mixing, packing,
    sharding, simhash, toxicity,
)
from earshot.llm.common import fold_of

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"

QUERIES = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def toxicity_model(spark: SparkSession, docs: DataFrame, folder: str):
    trains = fold_of(F.col("doc_id"), 3) != 1
    return toxicity.train(docs, table(spark, folder, "labels"), trains)


@_query()
def op1_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return context_mixing.score(table(spark, folder, "documents"))


def _sql_words(text: str) -> str:
    return "[" + ", ".join(f"'{word}'" for word in text.split()) + "]"


def _license_sql() -> str:
    """Every phrase at every place and every template in every run of words, without blocks or prefixes."""
    phrases = ", ".join(f"('{label}', {_sql_words(text)})" for label, text in licenses.PHRASES.items())
    templates = ", ".join(
        f"('{t.label}', {_sql_words(' '.join(t.words))}, {licenses.needed(len(t.words), licenses.CONTAINMENT)}, {t.span}, "
        f"{_sql_words(t.naming)}::VARCHAR[], {_sql_words(t.other)}::VARCHAR[])" for t in licenses.TEMPLATES
    )
    return rf"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
    phrases(label, own) AS (VALUES {phrases}),
    templates(label, own, least, span, naming, other) AS (VALUES {templates}),
    places AS (SELECT doc_id, i - 1 AS place, label FROM w, (SELECT unnest(range(1, len(ws) + 1)) AS i) AS t, phrases
        WHERE list_slice(ws, i, i + len(own) - 1) = own),
    base AS (SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY 1),
    near AS (SELECT * FROM w, templates WHERE len(list_intersect(list_distinct(ws), own)) >= least),
    runs AS (SELECT doc_id, label, own, least, naming, other, list_distinct(list_slice(ws, i, i + span - 1)) AS run
        FROM near, (SELECT unnest(range(1, greatest(len(ws) - span, 0) + 2)) AS i) AS t),
    found AS (SELECT doc_id, label, len(list_intersect(run, own)) / len(own) AS share FROM runs
        WHERE len(list_intersect(run, own)) >= least AND list_has_all(run, naming) AND NOT list_has_any(run, other)),
    every_label AS (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM found),
    named AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM every_label GROUP BY 1),
    best AS (SELECT doc_id, max(share) AS share FROM found GROUP BY 1)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
        coalesce(base.labels, '') AS base_labels, coalesce(named.labels, '') AS labels,
        greatest(coalesce(share, 0), CASE WHEN n > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS score
    FROM w LEFT JOIN base USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)"""


@_query(_license_sql())
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_labels(table(spark, folder, "documents")).drop("row_tag")


@_query()
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, folder))
    return scored.select(
        "doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= toxicity.CUT, 1).otherwise(0).alias("predicted"),
    )


@_query()
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=False)


@_query()
def op5_sampled_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query("""WITH RECURSIVE v AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND list_sum(list_transform(embedding, lambda x: CAST(x <> 0 AS INTEGER))) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
        least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
        vec_id <= coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id) AS kept
    FROM embeddings""")
def op6_projection_forest(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings")).drop("row_tag")


@_query(r"""WITH t AS (SELECT doc_id,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""")
def op7_digest_tree(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, folder, "documents")).drop("row_tag")


@_query()
def op8_byte_network(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold_of(F.col("doc_id"), 5) == 0
    found = language.predict(docs, language.train(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@_query(r"""WITH d AS (SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS k,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, source IS NULL AS unnamed FROM d GROUP BY source),
    w AS (SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY unnamed, source) - 1) % 3 + 1 AS INTEGER)]
        AS BIGINT) AS weight, 2 * source_size AS cap FROM s),
    l AS (SELECT *, (sum(source_size) OVER () * 3 / 2 - coalesce(sum(cap) OVER (ORDER BY cap / weight, unnamed, source
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, unnamed, source
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
    t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM l),
    r AS (SELECT *, floor(target / nullif(source_size, 0)) AS rounds,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
            0) AS ahead FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, CAST(size * (coalesce(rounds, 0) + CASE WHEN size > 0
        AND ahead + size / 2 <= target - coalesce(rounds, 0) * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r""")
def op9_prefix_sum_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("row_tag", "epochs")


@_query()
def op10_simhash_balls(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@_query(f"""WITH q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY 1, 2),
    d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
    c AS (SELECT count(*) AS n, CAST(sum(len(ts)) AS BIGINT) AS l FROM d WHERE len(ts) > 0),
    p AS (SELECT doc_id, size, t, count(*) AS tf FROM (SELECT doc_id, len(ts) AS size, unnest(ts) AS t FROM d) GROUP BY ALL),
    w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM p, c WHERE t IN (SELECT t FROM q) GROUP BY t),
    s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * size * n) // l))))
        AS BIGINT) AS score FROM p JOIN w USING (t) JOIN q USING (t), c GROUP BY 1, 2)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 10""")
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_query()
def op12_cutting_stock(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, with_ids=False)


@_query(r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    f AS (SELECT d.doc_id, part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
        {'A': len(ws) < 200, 'B': 100 * len(list_distinct(ws)) < 50 * len(ws),
         'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), 'D': regexp_matches(t, '[#$%&*|]'),
         'E': d.doc_id > min(d.doc_id) OVER (PARTITION BY t)} AS x FROM d LEFT JOIN labels USING (doc_id)),
    fails AS (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda k: x.A AND k = 'A'
        OR x.B AND k = 'B' OR x.C AND k = 'C' OR x.D AND k = 'D' OR x.E AND k = 'E') AS own FROM f),
    masks AS (SELECT part, own, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM fails GROUP BY 1, 2),
    l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
    o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM l a, l b, l c, l d, l e
        WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
    s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS k,
        string_split(filter_order[:step - 1], '') AS before FROM o, (SELECT unnest(range(1, 6)) AS step) AS t),
    r AS (SELECT part, filter_order, step, k, CAST(coalesce(sum(n) FILTER (NOT list_contains(own, k)
                AND len(list_intersect(own, before)) = 0), 0) AS BIGINT) AS kept,
        CAST(coalesce(sum(n) FILTER (list_contains(own, k) AND len(list_intersect(own, before)) = 0), 0) AS BIGINT) AS removed,
        CAST(coalesce(sum(n) FILTER (list_contains(own, k) AND len(list_intersect(own, before)) > 0), 0) AS BIGINT) AS redundant,
        CAST(coalesce(sum(n) FILTER (own = [k]), 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(sum(good) FILTER (list_contains(own, k) AND len(list_intersect(own, before)) = 0), 0) AS BIGINT) AS good_lost,
        CAST(coalesce(sum(toxic) FILTER (list_contains(own, k) AND len(list_intersect(own, before)) = 0), 0) AS BIGINT) AS toxic_lost
        FROM masks, s GROUP BY part, filter_order, step, k)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
        CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM r""")
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
