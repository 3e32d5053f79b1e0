"""Phrases, shards and runs against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from civica.llm import collocations, periodic_runs, queries, sharding

DOCS = "doc_id long, text string, lang string, size string, RUNS string, shard int"


def documents(spark, texts, langs=None):
    langs = langs or ["en"] * len(texts)
    return spark.createDataFrame([(k, t, x, "s", "r", 99) for k, (t, x) in enumerate(zip(texts, langs))], DOCS)


# Phrases


def brute_phrases(docs, least, longest, covered, top):
    count, words = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    count[lang][tuple(w[i: i + size])] += 1
    out = []
    for lang, found in count.items():
        rows = []
        often = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        for p, a in often.items():
            score, k = min((2_000_000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p)))
            inside = any(100 * b >= covered * a and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in often.items() if len(q) > len(p))
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -s))
    return sorted(out)


def zipf_texts(r, n, size):
    words = [f"w{k}" for k in range(60)] + ["Été", "N'est", "日本"]
    weights = [1 / (k + 1) for k in range(len(words))]
    return ["".join(x + r.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n"]) for x in r.choices(words, weights, k=size))
            for _ in range(n)]


@pytest.mark.parametrize("sample", [2, 1000])
def test_collocations(spark, rows, sample):
    r = random.Random(3)
    texts = zipf_texts(r, 150, 60) + ["alpha beta gamma delta, " * 40, None, "", "...", "x " * 200, "\x0b y\tz \r" * 31]
    langs = [r.choice(["en", "de", None]) for _ in texts]
    got = collocations.top_collocations(documents(spark, texts, langs), top=50, least=30, sample=sample, bits=1 << 12)
    assert rows(got) == sorted(brute_phrases(zip(texts, langs), 30, 4, 80, 50), key=repr)


def test_collocation_passes(spark):
    """A sample that misses everything leaves all phrases to the expansion."""
    docs = documents(spark, ["one two three four five"] * 40)
    found, totals, passes = collocations.frequent_phrases(docs, sample=1 << 40, bits=1 << 20)
    assert passes == 2
    assert {(r.phrase, r.n) for r in found.where("size = 4").collect()} == {("one two three four", 40), ("two three four five", 40)}
    assert [tuple(r) for r in totals.collect()] == [("en", 200)]


def test_collocations_repeated_rows_long_and_empty(spark, rows):
    text = "a b " * 20_000
    docs = documents(spark, [text])
    got = rows(collocations.top_collocations(docs.unionAll(docs)))
    assert got == sorted(brute_phrases([(text, "en")] * 2, 30, 4, 80, 2000), key=repr) and got
    assert rows(collocations.top_collocations(docs.limit(0))) == []


def test_no_pair_of_passes_counts_a_phrase_twice(spark):
    r = random.Random(8)
    docs = documents(spark, zipf_texts(r, 80, 80))
    found, _, passes = collocations.frequent_phrases(docs, least=10, sample=40, bits=1 << 8)
    assert found.groupBy("lang", "phrase").count().where("count > 1").isEmpty() and passes > 1


# Shards


def jump(key, shards):
    key, here, ahead = key % (1 << 64), -1, 0
    while ahead < shards:
        here, key = ahead, (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((here + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return here


@pytest.mark.parametrize("shards", [1, 2, 16, 63, 64, 65, 3000])
def test_jump_hash(spark, shards):
    r = random.Random(shards)
    keys = [None, 0, 1, -1, 2**63 - 1, -2**63] + [r.randrange(-2**63, 2**63) for _ in range(300)]
    frame = spark.createDataFrame([(k,) for k in keys], "key long")
    got = frame.select("key", sharding.jump_hash(frame["key"], shards)).collect()
    assert all(shard == jump(key or 0, shards) for key, shard in got)
    with pytest.raises(ValueError):
        sharding.jump_hash(frame["key"], 0)


def test_a_walk_of_many_steps_is_finished(spark, monkeypatch):
    monkeypatch.setattr(sharding, "STEPS", 2)
    frame = spark.range(200)
    got = frame.select("id", sharding.jump_hash(frame["id"], 500)).collect()
    assert all(shard == jump(key, 500) for key, shard in got)


def test_sharded(spark):
    texts = [None, "", "é", "z" * 300_000] + ["same"] * 300 + [f"t{k}" for k in range(300)]
    docs = documents(spark, texts)
    odd = spark.createDataFrame([(None, "n", "en", "", "", 0)] * 40 + [(7, "seven", "en", "", "", 0)] * 90, DOCS)
    got = sharding.sharded(docs.unionAll(odd), 16).collect()
    assert len(got) == len(texts) + 130
    slots = defaultdict(list)
    for row in got:
        assert row.shard == jump(row.doc_id or 0, 16) and row.grown_shard in (row.shard, 16) and row.law == "key"
        slots[row.shard].append((row.slot, row.doc_id is not None, row.doc_id or 0, row.size, row.text_crc32))
        if row.doc_id is not None and row.doc_id < len(texts) and row.text_crc32 != zlib.crc32(b"seven"):
            data = (texts[row.doc_id] or "").encode()
            assert (row.size, row.text_crc32) == (len(data) + 1, zlib.crc32(data))
    for found in slots.values():
        found.sort()
        assert [x[0] for x in found] == list(range(len(found)))
        assert [x[1:] for x in found] == sorted(x[1:] for x in found)
    assert sharding.sharded(docs.limit(0)).count() == 0


def test_placed_and_written_shards(spark, tmp_path):
    docs = documents(spark, [f"t{k}" for k in range(200)])
    assert sharding.placed(docs, 4).columns == docs.columns  # a former shard is replaced
    assert sharding.placed(docs, 4, key="text", out="part").where("part between 0 and 3").count() == 200
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(k, jump(k, 4)) for k in range(200)}


# Runs


def brute_runs(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            end = i
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end + q - i >= max(least, 2 * q):
                found.setdefault((i, end + q - i), q)
            i = max(end, i) + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed(words, found):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found))


def periodic_text(r):
    letters, words = "ab" if r.random() < 0.5 else "abcdefg", []
    while len(words) < r.choice([0, 5, 30, 90, 200]):
        unit = [r.choice(letters) for _ in range(r.randint(1, 24))]
        words += (unit * r.randint(1, 7))[: r.randint(1, 80)]
        if r.random() < 0.3:
            words += words[: r.randint(0, len(words))]
    return words


@pytest.mark.parametrize("least", [2, 5, 12, 31])
def test_periodic_runs(spark, least):
    r = random.Random(least)
    lists = [periodic_text(r) for _ in range(150)] + [["x"] * 500, ["a", "b"] * 400, [f"w{k}" for k in range(300)]]
    texts = ["".join(r.choice([" ", "\n", "\t ", "\x0c"]) + w for w in words) for words in lists]
    got = {row.doc_id: row for row in periodic_runs.periodic_runs(documents(spark, texts), least).collect()}
    assert len(got) == len(lists)
    for k, words in enumerate(lists):
        want = brute_runs(words, least)
        assert [tuple(x) for x in got[k].runs] == want
        assert (got[k].n_words, got[k].collapsed) == (len(words), collapsed(words, want))


def test_periodic_runs_on_odd_rows(spark):
    texts = [None, "", " \n ", "a", "  " * 14, "ab " * 100_000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "b " * 20)] * 2
    got = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    by_id = {row.doc_id: row for row in got}
    assert all((by_id[k].n_words, by_id[k].runs, by_id[k].collapsed) == (0, [], "") for k in (0, 1, 2))
    assert by_id[3].collapsed == "a" and [tuple(x) for x in by_id[4].runs] == [(0, 14, 1)]
    assert [tuple(x) for x in by_id[5].runs] == [(0, 100_000, 1)] and by_id[5].collapsed == "ab"
    assert [tuple(x) for x in by_id[None].runs] == [(0, 20, 1)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.periodic_runs(empty).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(empty, 1)


def test_long_texts_are_split_by_bytes_alone(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK", 64)
    r = random.Random(2)
    lists = [periodic_text(r) for _ in range(40)]
    got = {row.doc_id: row for row in periodic_runs.periodic_runs(documents(spark, [" ".join(w) for w in lists])).collect()}
    assert all([tuple(x) for x in got[k].runs] == brute_runs(w, 12) for k, w in enumerate(lists))


def test_periodic_query(spark, tmp_path):
    """The whole contract, planting included, in plain Python."""
    r = random.Random(4)
    texts = [" ".join(periodic_text(r)) for _ in range(120)] + [None, "", "only one"] * 8
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {row.doc_id: row for row in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    changed = 0
    for k, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(k).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            new = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
            changed, words = changed + (new != words), new
        found, row = brute_runs(words, 12), got[k]
        first = min(((-n, s, q) for s, n, q in found), default=None)
        want = (first[1], -first[0], first[2], 1000 * -first[0] // first[2]) if first else (None,) * 4
        assert (row.n_runs, (row.start, row.length, row.period, row.exponent_milli)) == (len(found), want)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
    assert changed > 5
