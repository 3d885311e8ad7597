"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import bpe, divergence, hnsw, html, lines, mix, pack, pii, quality, resample, shards, simhash, urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranks_file() -> tuple[str, str, str]:
    """The public tokenizer that op3 names, the same vocabulary as ranks, and its split pattern."""
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def tokenizer_file() -> str:
    """The public tokenizer that op13 names."""
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json")


def op1_mix_sources(spark, sf_dir):
    mixed = mix.mix(table(spark, sf_dir, "documents"))
    return mix.document_shares(mixed).select("doc_id", "size", "source_size", "target", "taken")


def op2_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    mined = urls.mine_rules(urls.labelled_pages(pages, table(spark, sf_dir, "labels")))
    return urls.judge_urls(pages, mined)


def op3_best_fit_packing(spark, sf_dir):
    return pack.pack_documents(table(spark, sf_dir, "documents"), *ranks_file())


def op4_quality_rules(spark, sf_dir):
    return quality.judge_documents(table(spark, sf_dir, "documents"), ["doc_id"])


def op5_html_extraction(spark, sf_dir):
    return html.extract_text(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark, sf_dir):
    return lines.dedup_lines(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


def op7_balanced_shards(spark, sf_dir):
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_hnsw_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hnsw.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def op10_personal_data(spark, sf_dir):
    return pii.find_personal(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark, sf_dir):
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark, sf_dir):
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_bpe_encoding(spark, sf_dir):
    return bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file(), digest=True)


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_url_filters, op3_best_fit_packing, op4_quality_rules, op5_html_extraction, op6_line_dedup,
                                   op7_balanced_shards, op8_simhash_near_dedup, op9_hnsw_search, op10_personal_data,
                                   op11_source_divergence, op12_importance_resampling, op13_bpe_encoding)}

ORACLE = {
    "op6_line_dedup": """
WITH ds AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
ls AS (SELECT r, doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM ds),
ks AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM ls),
hot AS (SELECT key FROM ks WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, doc_id, i, line, key NOT IN (SELECT key FROM hot) AS keep FROM ks)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT keep) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keep), '')) AS kept_sha256
FROM kept GROUP BY r, doc_id""",
    "op11_source_divergence": r"""
WITH ds AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
ts AS (SELECT r, lang, source, unnest(terms) AS term FROM ds),
kept AS (SELECT lang, term, count(*) AS ln FROM ts GROUP BY ALL HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(ln)::HUGEINT AS total FROM kept GROUP BY ALL),
counts AS (SELECT lang, source, term, count(*) AS n FROM ts JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM ds),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
prices AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.total + 5 * l.v) AS p,
    1 + 1000000000::HUGEINT * (k.ln + 5) // (l.total + 5 * l.v) AS q
    FROM totals g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM prices a JOIN prices b USING (lang, term)
    WHERE a.source <> b.source GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM prices WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 50""",
    "op12_importance_resampling": r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (SELECT row_number() OVER () AS r, doc_id, text, true AS own FROM documents UNION ALL SELECT -row_number() OVER (), NULL, text, false FROM benchmark),
ws AS (SELECT r, doc_id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
occurrences AS (SELECT r, own, unnest(w || list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM ws),
fs AS (SELECT f, list_transform(range(strlen(f)), lambda i: ('0x' || hex(f)[2 * i + 1:2 * i + 2])::BIGINT) AS bytes FROM (SELECT DISTINCT f FROM occurrences)),
buckets AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM fs, crc),
counts AS (SELECT bucket, count(*) FILTER (WHERE own) AS s, count(*) FILTER (WHERE NOT own) AS t FROM occurrences JOIN buckets USING (f) GROUP BY ALL),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts),
weights AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS total FROM occurrences JOIN buckets USING (f) JOIN gains USING (bucket) WHERE own GROUP BY ALL),
scored AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, floor(coalesce(total / n_features, 0))::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS draw
    FROM ws LEFT JOIN weights USING (r) WHERE own),
ranked AS (SELECT *, weight + draw AS score, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + draw DESC, doc_id NULLS LAST) AS place,
    count(*) FILTER (WHERE n_words >= 20) OVER () AS able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * able // 100 THEN place END AS rank FROM ranked""",
}
