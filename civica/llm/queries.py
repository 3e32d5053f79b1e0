"""The operators as queries over whole tables, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from civica.llm import (
    chat_format,
    collocations,
    decontamination,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    periodic_runs,
    quality,
    sentencepiece_bpe,
    sharding,
    topk_search,
    url_filter,
)
from civica.llm.common import LOWER, UPPER, read_table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return topk_search.top_k(rows.where("vec_id % 50 = 0"), rows, k=5)


def op2_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(read_table(spark, sf_dir, "documents")).drop("matches")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encoded(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_kept", "n_near")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(read_table(spark, sf_dir, "pages")).drop("matched")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.linked(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.formatted(read_table(spark, sf_dir, "conversations"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_collocations(read_table(spark, sf_dir, "documents"))


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read_table(spark, sf_dir, "documents"))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in one document of ten, by the crc32 of its id, the words from some
    word on repeat with a period; both follow from the crc32. A null id plants nothing."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select("doc_id", "text", (F.floor(h / 10)).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.col("g") % F.col("n").cast("bigint"))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    unit = F.slice("words", F.col("a").cast("int") + 1, F.col("p").cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted(read_table(spark, sf_dir, "documents")))
    first = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.withColumn("first", first)
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("first.col2")).alias("start"),
        F.col("first.length").alias("length"), (-F.col("first.col3")).alias("period"),
        F.expr("1000 * first.length div -first.col3").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_topk, op2_license, op3_sentencepiece, op4_line_dedup, op5_url_filter, op6_quality, op7_language,
        op8_jaccard, op9_chat, op10_decontamination, op11_collocations, op12_shards, op13_periodic_runs)
} | {"pipeline": corpus_pipeline.run}


def _ascii_lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_TOPK = """
WITH q AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _url_sql() -> str:
    rules = sorted(url_filter.HOST_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))", h + p, v) for h, p, v in rules]
    rule = "".join(f" WHEN {test} THEN '{text}'" for test, text, _ in fits)
    verdict = "".join(f" WHEN {test} THEN '{v}'" for test, _, v in fits)
    tests = {flag: " OR ".join(f"regexp_matches(low, '{url_filter.to_regex(p, '$')}')" for p in url_filter.PATTERNS
                               if p.startswith("@@") == flag) for flag in (True, False)}
    return f"""
WITH cut AS (
    SELECT page_id, {_ascii_lower('url')} AS low,
           CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id, low, {_ascii_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path, CASE{rule} END AS rule,
       CASE{verdict} WHEN ({tests[False]}) AND NOT ({tests[True]}) THEN 'block' ELSE 'allow' END AS verdict
FROM parts
"""


_JACCARD = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_ascii_lower('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
        range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT doc_id, len(s) AS n_shingles, component_id
FROM sets JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) ON a = doc_id
"""

_DECONTAMINATION = f"""
WITH words AS (
    SELECT doc_id AS id, false AS item, regexp_extract_all({_ascii_lower('text')}, {_ALNUM}) AS w FROM documents
    UNION ALL SELECT item_id, true, regexp_extract_all({_ascii_lower('text')}, {_ALNUM}) FROM benchmark),
sets AS (
    SELECT id, item, list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM words WHERE len(w) >= 5),
flat AS (SELECT id, item, len(s) AS n, unnest(s) AS g FROM sets),
met AS (
    SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, i.n AS n_item
    FROM flat d JOIN flat i ON d.g = i.g AND i.item AND NOT d.item GROUP BY d.id, i.id, i.n),
short AS (SELECT id, len(w) AS m, array_to_string(w, ' ') AS g FROM words WHERE item AND len(w) BETWEEN 1 AND 4),
held AS (
    SELECT id, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS g
    FROM words, (SELECT DISTINCT m FROM short) WHERE NOT item AND len(w) >= m)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM met WHERE 10 * n_shared >= 8 * n_item
UNION ALL SELECT DISTINCT d.id, i.id, 1, 1, 1.0 FROM held d JOIN short i ON d.g = i.g
"""

def _collocations_sql() -> str:
    separators = r"[.,;:!?\x0A-\x0D]"
    grams = " UNION ALL ".join(
        f"SELECT lang, {size} AS size, unnest(list_transform(range(1, len(w) - {size - 2}), "
        f"lambda i: array_to_string(w[i:i + {size - 1}], ' '))) AS phrase FROM words" for size in range(1, 5))
    cut = "array_to_string(string_split(phrase, ' ')[{}:{}], ' ')"
    return f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_ascii_lower('text')}, '{separators}')) AS piece
    FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS ({grams}),
f AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
    SELECT lang, size, phrase, a, k, {cut.format('1', 'k')} AS head, {cut.format('k + 1', 'size')} AS tail
    FROM f, range(1, 4) t(k) WHERE k < size),
scored AS (
    SELECT c.lang, c.size, c.phrase, c.a, k, h.a AS l, t.a AS r,
           ((2000000::HUGEINT * c.a) // (h.a::HUGEINT + t.a))::BIGINT AS score
    FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
shadowed AS (
    SELECT b.lang, b.phrase FROM best b JOIN f ON f.lang = b.lang AND f.size > b.size
    AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ') AND 100::HUGEINT * f.a >= 80::HUGEINT * b.a),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM best ANTI JOIN shadowed USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _crc_table() -> str:
    rows = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        rows.append(value)
    return f"({rows}::BIGINT[])"


_SHARDS = f"""
WITH RECURSIVE given AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS id FROM documents),
bytes AS (SELECT id, strlen(text) AS size, hex(encode(text)) AS h FROM given),
crc AS (
    SELECT id, size + 1 AS size, xor(4294967295, list_reduce(
        list_transform(range(1, size + 1), lambda i: ('0x' || h[2 * i - 1:2 * i])::BIGINT),
        lambda c, v: xor(c >> 8, {_crc_table()}[(xor(c, v) & 255) + 1]), 4294967295::BIGINT))::BIGINT AS crc FROM bytes),
walk AS (
    SELECT id, ((coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616)::UHUGEINT AS key, -1::BIGINT AS here,
           0::BIGINT AS next FROM given
    UNION ALL
    SELECT id, state, next, floor((next + 1)::DOUBLE * (2147483648::DOUBLE / ((state >> 33) + 1)::DOUBLE))::BIGINT FROM (
        SELECT *, (key * 2862933555777941757 + 1) % 18446744073709551616 AS state FROM walk WHERE next < 17)),
shards AS (
    SELECT id, max(here) FILTER (next >= 17) AS grown, max(here) FILTER (here < 16) AS shard FROM walk GROUP BY id)
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, crc) - 1 AS slot, grown::INTEGER AS grown_shard
FROM given JOIN crc USING (id) JOIN shards USING (id)
"""

ORACLES = {
    "op1_topk": _TOPK,
    "op5_url_filter": _url_sql(),
    "op8_jaccard": _JACCARD,
    "op10_decontamination": _DECONTAMINATION,
    "op11_collocations": _collocations_sql(),
    "op12_shards": _SHARDS,
}
