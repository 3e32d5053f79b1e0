"""Language ID by Bayesian fusion of text, markup, address and host evidence.

1. Byte trigram counts of labelled documents (a bounded sample) give each language's text
   likelihoods.
2. Every page gets the likelihood of its visible text, its declared markup language, the
   suffix of its address, and its host.
3. Grouped aggregation over all pages counts, by the language of the text alone, how
   often languages declare what, under which suffix, and on which host. Host priors are
   smoothed towards their domain, and these towards the whole.
4. The posterior multiplies all evidence; a page's own count is taken out of the priors.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civica.llm.common import bounded_broadcast, stored
from civica.llm.url_filter import host_and_path

# Documents learned from, at most about this many of each language (chosen by hash).
SAMPLE_PER_LANGUAGE = 2_000
BUCKETS = 1 << 14
# Trigrams of running text are far from independent; their evidence counts this much.
TEXT_WEIGHT = 0.2
SMOOTHING = 5.0
HIDDEN = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


def trigrams(text: str) -> np.ndarray:
    """Hash buckets of the byte trigrams of a text in lower case, digits left out."""
    data = np.frombuffer(re.sub(r"[\W\d_]+", " ", text.lower()).encode(), np.uint8).astype(np.int64)
    if len(data) < 3:
        return np.empty(0, np.int64)
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * 0x9E3779B1 & 0xFFFFFFFF
    return code >> 18


def visible(page: str) -> str:
    return html.unescape(HIDDEN.sub(" ", page))


class TextModel:
    """Log likelihoods of trigram buckets, one row per language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        self.logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)) if languages else np.zeros((0, BUCKETS))

    def evidence(self, text: str) -> np.ndarray:
        found = trigrams(text)
        total = np.zeros(len(self.languages))
        for at in range(0, len(found), 1 << 18):
            total += self.logs[:, found[at: at + (1 << 18)]].sum(axis=1)
        return TEXT_WEIGHT * total


def fitted(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> TextModel:
    """Learn from ``text, lang`` of a sample; rows without either are left out."""
    rows = docs.where("text is not null and lang is not null").select(
        F.xxhash64("doc_id", "text").alias("key"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return TextModel([], np.zeros((0, BUCKETS)))
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(per_language / n))])
    sample = rows.where(F.pmod("key", F.lit(1 << 30)) < share[F.col("lang")] * float(1 << 30)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())],
                names=["lang", "bucket", "n"])

    rows = sample.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = sorted(sizes)
    counts, place = np.zeros((len(languages), BUCKETS)), {lang: k for k, lang in enumerate(languages)}
    for r in rows.toLocalIterator():  # languages times buckets, however many documents
        counts[place[r["lang"]], r["bucket"]] = r["n"]
    return TextModel(languages, counts)


def declared_language(page: Column) -> Column:
    """The main tag of the lang attribute of the html element; '' without one."""
    tag = F.regexp_extract(page, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1)
    return F.lower(F.coalesce(tag, F.lit("")))


def text_evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    """``page_id, host, domain, suffix, declared, evidence, text_lang`` of every page."""
    host, _ = host_and_path(F.col("url").cast("string"))
    bare = F.regexp_replace(host, r"^.*@|:\d*$", "")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), bare.alias("host"),
        declared_language(F.col("html").cast("string")).alias("declared"), F.col("html").cast("string").alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            evidence = [found.evidence(visible(page or "")) for page in batch.column(3).to_pylist()]
            best = [int(np.argmax(x)) if x.any() else None for x in evidence]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([x.tolist() for x in evidence], pa.list_(pa.float64())), pa.array(best, pa.int32())],
                names=["page_id", "host", "declared", "evidence", "text_lang"])

    rows = rows.mapInArrow(score, "page_id bigint, host string, declared string, evidence array<double>, text_lang int")
    labels = F.split("host", r"\.")
    suffix = F.coalesce(F.try_element_at(labels, F.lit(-1)), F.lit(""))
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    return rows.withColumns({"suffix": suffix, "domain": domain})


def counted(rows: DataFrame, key: str, n: int) -> DataFrame:
    """How many pages of each key have each text language, as an array."""
    per = [F.count_if(F.col("text_lang") == k).cast("double") for k in range(n)]
    return rows.groupBy(key).agg(F.array(*per).alias(f"{key}_counts"))


def identified(pages: DataFrame, docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE,
               smoothing: float = SMOOTHING) -> DataFrame:
    """Language of every page.

    pages: ``page_id, url, html``; docs: ``doc_id, text, lang`` to learn from. Returns
    ``page_id, host, suffix, declared, text_lang, lang, confidence``, a row for each row
    of pages: the language by the text alone (null without letters), the one with the
    highest posterior, and that posterior.

    Null urls have the empty host, null html no text and no declaration; such pages are
    judged by what is left, the smoothed priors at least. Ties go to the language that
    sorts first. Empty pages give no rows; without labelled documents lang is null.
    Repeated rows are judged alike. Pages are read whole. Other columns are not read.
    """
    model = fitted(docs, per_language)
    n = len(model.languages)
    rows = stored(text_evidence(pages, model), "evidence")
    if not n:
        none = F.lit(None)
        return rows.select("page_id", "host", "suffix", "declared", none.cast("string").alias("text_lang"),
                           none.cast("string").alias("lang"), none.cast("double").alias("confidence"))
    hosts = stored(rows.groupBy("host", "domain", "suffix").agg(F.array(*[
        F.count_if(F.col("text_lang") == k).cast("double") for k in range(n)]).alias("host_counts")), "hosts")
    summed = lambda key: hosts.groupBy(key).agg(F.array(*[
        F.sum(F.col("host_counts")[k]) for k in range(n)]).alias(f"{key}_counts"))
    every = F.array(*[F.sum(F.col("host_counts")[k]) for k in range(n)])
    everything = (hosts.agg(F.coalesce(every, F.array(*[F.lit(0.0)] * n))).first() or [[0.0] * n])[0]
    everything = [x or 0.0 for x in everything]
    total = sum(everything)
    world = F.array(*[F.lit((x + 1) / (total + n)) for x in everything])

    own = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.when(F.col("text_lang") == k, 1.0).otherwise(0.0))
    sides = hosts.select("host", "domain", "suffix", "host_counts").join(summed("domain"), "domain")
    sides = sides.join(bounded_broadcast(stored(summed("suffix"), "suffixes")), "suffix")
    sides = bounded_broadcast(stored(sides.select(
        F.col("host").alias("_host"), "host_counts", "domain_counts", "suffix_counts"), "sides"), 100_000)
    tags = bounded_broadcast(stored(counted(rows, "declared", n).withColumnRenamed("declared", "_tag"), "tags"), 100_000)
    met = rows.join(sides, rows["host"] == sides["_host"]).join(tags, rows["declared"] == tags["_tag"])

    def less_own(counts: str) -> Column:
        return F.zip_with(counts, own, lambda a, b: a - b)

    def towards(counts: Column, prior: Column) -> Column:
        size = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(counts, prior, lambda c, p: (c + smoothing * p) / (size + smoothing))

    def given(counts: str) -> Column:
        """P(evidence | language), up to a factor: its share among the language's pages."""
        pairs = F.zip_with(less_own(counts), F.array(*[F.lit(x) for x in everything]), lambda c, a: (c + 0.5) / (a + 1.0))
        return F.transform(pairs, lambda x: F.log(x))

    prior = towards(less_own("host_counts"), towards(less_own("domain_counts"), world))
    logs = F.zip_with("evidence", F.transform(prior, lambda p: F.log(p)), lambda a, b: a + b)
    # Pages that declare nothing say nothing.
    logs = F.zip_with(logs, given("declared_counts"), lambda a, b: a + F.when(F.col("declared") == "", 0.0).otherwise(b))
    logs = F.zip_with(logs, given("suffix_counts"), lambda a, b: a + F.when(F.col("suffix") == "", 0.0).otherwise(b))
    judged = met.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    names = F.lit(model.languages)
    odds = F.aggregate(F.transform("logs", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda s, x: s + x)
    return judged.select(
        "page_id", "host", "suffix", "declared", F.get(names, F.col("text_lang")).alias("text_lang"),
        F.get(names, (F.array_position("logs", F.col("top")) - 1).cast("int")).alias("lang"),
        (F.lit(1.0) / odds).alias("confidence"))
