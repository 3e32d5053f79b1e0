"""URL filters: pattern rules indexed by their rarest literal token.

A pattern is literal text with ``*`` (anything), ``^`` (a separator or the end), ``||`` at
its start (any subdomain) and ``@@`` before it (an exception). Tokens of a pattern that
must stand as whole tokens in any URL it fits are counted over all URLs; the rarest one
indexes the pattern. A URL's tokens fetch candidates, and only those run their regular
expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civica.llm.common import ascii_lower

ALLOW, BLOCK = "allow", "block"

# Host, path and verdict of the rules every URL is held against first.
HOST_RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)

PATTERNS = (
    "||ads-track.example.com^",
    "||ads-track.example.net^",
    "||ads-track.example.org^",
    "||adserver.*^",
    "/ads/*^banner",
    "^utm_campaign=spam",
    "^sessionid=",
    "/login^",
    "/signup^",
    "/cart/checkout^",
    "/tag/*/page/",
    "/wp-admin^",
    ".exe|",
    "/casino-",
    "@@/docs/login^",
    "@@||status.ads-track.example.com^",
)

TOKEN = re.compile(r"[a-z0-9]+")


def to_regex(pattern: str, end_of_text: str = r"\Z") -> str:
    """The regular expression of a pattern, over URLs in lower case."""
    body = pattern.removeprefix("@@")
    start = ""
    if body.startswith("||"):
        start, body = r"^[a-z][a-z0-9+.-]*://([^/?#]*\.)?", body[2:]
    end = end_of_text if body.endswith("|") else ""
    body = body.removesuffix("|")
    pieces = {"*": "(?s:.*)", "^": f"([^a-z0-9_.%-]|{end_of_text})"}
    return start + "".join(pieces.get(c) or re.sub(r"[^a-z0-9/_=:-]", r"\\\g<0>", c) for c in body) + end


def whole_tokens(pattern: str) -> set[str]:
    """Tokens that any URL fitting the pattern has as whole tokens."""
    body = pattern.removeprefix("@@")
    anchored = body.startswith("||")
    body = body.removeprefix("||")
    closed = body.endswith("|")
    body = body.removesuffix("|")
    found = set()
    for m in TOKEN.finditer(body):
        left = anchored if m.start() == 0 else body[m.start() - 1] != "*"
        right = closed if m.end() == len(body) else body[m.end()] != "*"
        if left and right:
            found.add(m.group())
    return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between ``://`` and ``/``, ``?`` or ``#``, and the path after it."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def host_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The longest rule (text, verdict) that fits; of equally long ones the longer host."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))
    table = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(p).alias("p"), F.lit(v).alias("v")) for h, p, v in ordered])
    fits = F.filter(table, lambda r: ((host == r["h"]) | host.endswith(F.concat(F.lit("."), r["h"])))
                    & path.startswith(r["p"]))
    return F.get(fits, F.lit(0))


def token_counts(urls: Column, pages: DataFrame, tokens: set[str]) -> dict[str, int]:
    """In how many rows each of the given tokens stands. Bounded by the rules' tokens."""
    listed = F.array_distinct(F.regexp_extract_all(ascii_lower(urls), F.lit("([a-z0-9]+)")))
    rows = pages.select(F.explode(listed).alias("token")).where(F.col("token").isin(*sorted(tokens)))
    return {r["token"]: r["count"] for r in rows.groupBy("token").count().collect()} if tokens else {}


def pattern_index(patterns: tuple[str, ...], counts: dict[str, int]) -> dict[str, list[int]]:
    """Pattern numbers by rarest token; those without a whole token are under ''."""
    index: dict[str, list[int]] = {}
    for k, pattern in enumerate(patterns):
        tokens = sorted(whole_tokens(pattern), key=lambda t: (counts.get(t, 0), -len(t), t))
        index.setdefault(tokens[0] if tokens else "", []).append(k)
    return index


def judged(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = HOST_RULES,
           patterns: tuple[str, ...] = PATTERNS) -> DataFrame:
    """Host, path, rule and verdict of every page.

    pages: ``page_id, url``. Returns ``page_id, host, path, rule, verdict, matched``. A
    host rule decides where one fits (``rule`` is its text, else null); otherwise a
    pattern that fits blocks, unless an exception fits too, and what nothing fits is
    allowed. matched is the smallest number of a fitting blocking pattern, else null.

    A null URL or one without ``://`` has an empty host and path; patterns still run on
    its text. Empty tables give no rows; repeated rows and null ids are kept. URLs of any
    length are read whole. Other columns are not read. The rules go to every task, so
    their number is bounded by what the caller holds in a tuple.
    """
    url = F.col("url").cast("string")
    tokens = set().union(*map(whole_tokens, patterns))
    index = pattern_index(patterns, token_counts(url, pages, tokens))
    compiled = [re.compile(to_regex(p)) for p in patterns]
    exception = [p.startswith("@@") for p in patterns]

    @F.pandas_udf("int")
    def first_pattern(urls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        always = index.get("", [])
        for batch in urls:
            found: list[int | None] = []
            for text in batch:
                hits = [k for token in {"", *TOKEN.findall(text or "")} for k in index.get(token, always if token == "" else [])
                        if compiled[k].search(text or "")]
                blocks = [k for k in hits if not exception[k]]
                found.append(min(blocks) if blocks and len(blocks) == len(hits) else None)
            yield pd.Series(found, dtype="Int32")

    host, path = host_and_path(url)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"),
                        first_pattern(ascii_lower(url)).alias("matched"))
    rule = host_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("_rule", rule)
    return rows.select(
        "page_id", "host", "path",
        F.when(F.col("_rule").isNotNull(), F.concat("_rule.h", "_rule.p")).alias("rule"),
        F.coalesce("_rule.v", F.when(F.col("matched").isNotNull(), F.lit(BLOCK)).otherwise(F.lit(ALLOW))).alias("verdict"),
        "matched")
