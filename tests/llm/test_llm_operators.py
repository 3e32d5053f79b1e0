"""The operators against brute force, and on odd rows."""

import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from civica.llm import (
    chat_format,
    decontamination,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    quality,
    queries,
    sentencepiece_bpe,
    topk_search,
    url_filter,
)

TEXT = "doc_id long, text string, root string, place string"
ODD = [(1, None, "x", "y"), (2, "", "x", "y"), (None, "one two three four five six", "x", "y"),
       (3, "one two three four five six", "x", "y"), (3, "one two three four five six", "x", "y"),
       (4, "a" * 50_000, "x", "y"), (5, "Mit LICENSE and cc by", "x", "y")]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, TEXT)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_top_k(spark, rows):
    r = random.Random(1)
    vectors = [(k, [r.uniform(-1, 1) for _ in range(6)]) for k in range(120)]
    vectors += [(k, vectors[3][1]) for k in range(200, 260)]
    given = vectors + [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (None, [0.0] * 6), vectors[0]]
    frame = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    got = rows(topk_search.top_k(frame.where("vec_id % 50 = 0"), frame), "query_id", "rank", "vec_id", "score")
    whole = {k: [int(256 * x // 1) for x in v] for k, v in vectors}
    want = []
    for q in (k for k in whole if k % 50 == 0):
        best = sorted((-sum(x * y for x, y in zip(whole[q], v)), k) for k, v in whole.items() if k != q)[:5]
        want += [(q, n, k, -s) for n, (s, k) in enumerate(best, 1)]
    assert got == sorted(want, key=repr)


def test_top_k_of_vectors_of_any_length(spark, rows):
    r = random.Random(2)
    given = [(0, [1.0, 2.0, 0.5]), (1, [9e6, 1.0, 0.0]), (2, [3.0, 3.0, 3.0]), (3, [0.0, 0.0, 0.0])]
    given += [(k, [r.choice([-1, 1]) * r.uniform(0.5, 1) * 2.0 ** r.choice([0, 8, 24, 26, 40, 50]) for _ in range(3)])
              for k in range(4, 160)]
    frame = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    got = rows(topk_search.top_k(frame.where("vec_id % 5 = 0"), frame), "query_id", "rank", "vec_id", "score")
    whole = {k: [math.floor(256 * x) for x in v] for k, v in given}
    want = []
    for q in (k for k in whole if k % 5 == 0):
        best = sorted((-sum(x * y for x, y in zip(whole[q], v)), k) for k, v in whole.items() if k != q)[:5]
        want += [(q, n, k, max(min(-s, 2**63 - 1), -(2**63))) for n, (s, k) in enumerate(best, 1)]
    assert got == sorted(want, key=repr)


def test_top_k_of_nothing_and_of_other_dimensions(spark, rows):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, rank string, qid string")
    assert topk_search.top_k(empty, empty).collect() == []
    mixed = spark.createDataFrame(
        [(0, [1.0, 1.0]), (1, [1.0]), (2, [2.0, 0.0]), (3, []), (4, [5.0])], "vec_id long, embedding array<float>")
    assert topk_search.top_k(empty, mixed).collect() == []
    assert rows(topk_search.top_k(mixed.where("vec_id < 2"), mixed)) == [(0, 1, 2, 131072), (1, 1, 4, 327680)]


def best_of(whole, k, ids):
    """Brute force over (vec_id, integer vector): a candidate of each row, ties by id."""
    want = []
    for q, v in {(q, v) for q, v in whole if q in ids}:
        best = sorted((-sum(x * y for x, y in zip(v, w)), c) for c, w in whole if c != q and len(v) == len(w))[:k]
        want += [(q, n, c, max(min(-s, 2**63 - 1), -(2**63))) for n, (s, c) in enumerate(best, 1)]
    return sorted(want, key=repr)


@pytest.mark.parametrize("kind", ["ties", "spread", "long"])
def test_top_k_over_many_blocks(spark, rows, monkeypatch, kind):
    for name, value in (("BLOCK_ROWS", 16), ("GROUP", 2), ("WAVE", 2), ("FILES", 3)):
        monkeypatch.setattr(topk_search, name, value)
    r = random.Random(len(kind))
    draw = {"ties": lambda: r.choice([-1.0, 0.0, 1.0]), "spread": lambda: r.uniform(-1, 1),
            "long": lambda: r.uniform(-1, 1) * 2.0 ** r.choice([0, 0, 12, 44, 50])}[kind]
    given = [(k, [draw() for _ in range(5)]) for k in range(400)] + [(k, [draw()]) for k in range(400, 440)]
    given += [(7, [draw() for _ in range(5)]), given[20], (900, given[20][1]), (901, [0.0] * 5)]
    frame = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    whole = {(k, tuple(math.floor(256 * x) for x in v)) for k, v in given}
    ids = {k for k, _ in given if k % 9 == 0 or k in (7, 901)} - {7}
    for slices in (1, 3):
        got = rows(topk_search.top_k(frame.where(F.col("vec_id").isin(*ids)), frame, k=4, slices=slices),
                   "query_id", "rank", "vec_id", "score")
        assert got == best_of(whole, 4, ids)


def steps(plan):
    """The operators of a plan that ran."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec" or name.endswith("QueryStageExec"):
        yield from steps(plan.executedPlan() if name == "AdaptiveSparkPlanExec" else plan.plan())
    yield plan
    for k in range(plan.children().size()):
        yield from steps(plan.children().apply(k))


def test_top_k_sends_few_entries(spark):
    r = np.random.default_rng(3)
    given = [(k, v.tolist()) for k, v in enumerate(r.normal(size=(3000, 32)))]
    found = topk_search.top_k(*[spark.createDataFrame(x, "vec_id long, embedding array<float>") for x in (given[::20], given)])
    assert len(found.collect()) == 5 * 150
    made = [(s.nodeName(), s.metrics().apply("numOutputRows").value()) for s in steps(found._jdf.queryExecution().executedPlan())
            if s.metrics().contains("numOutputRows")]
    assert len(made) > 5 and all(n <= 3000 for _, n in made), made


def asked(ids, v, wanted, room, floor=None):
    floor = np.full(len(ids), -np.inf) if floor is None else floor
    return topk_search.Asked(v.shape[1], ids.tobytes(), v.tobytes(), floor.tobytes(), wanted, 2, room)


def test_top_k_keeps_the_best_of_a_task(monkeypatch):
    monkeypatch.setattr(topk_search, "PENDING", 50)
    monkeypatch.setattr(topk_search, "TILE", 300)
    r = np.random.default_rng(4)
    v = r.integers(-3, 4, (500, 3)).astype(np.int16)
    queries = asked(np.arange(40), v[:40], 6, topk_search.Room())
    for at in np.split(r.permutation(500), [4, 90, 97, 300]):
        queries.meet(topk_search.Block(3, at.tobytes(), v[at].tobytes(), 2), at)
    q, low, high, first, cid = queries.settle()
    assert (low == high).all() and (first == cid).all()
    for k in range(40):
        scores = v.astype(int) @ v[k].astype(int)
        want = np.lexsort((np.arange(500), -scores))[:6]
        assert first[q == k].tolist() == want.tolist() and low[q == k].tolist() == scores[want].tolist()


def test_top_k_packs_narrow_integers_and_keeps_floors():
    for most, kind in ((32767, "int16"), (32768, "int32"), (2**40, "int64")):
        v = np.array([[most, -most], [1, 2]])
        block = topk_search.Block(2, np.arange(2).tobytes(), v.astype(kind).tobytes(), 2)
        assert block.v.dtype == kind and block.v.tolist() == v.tolist()
    v = np.array([[1, 0], [2, 0], [3, 0], [4, 0]], np.int16)
    queries = asked(np.array([9]), v[:1], 2, topk_search.Room(), np.array([3.0]))
    queries.meet(topk_search.Block(2, np.arange(4).tobytes(), v.tobytes(), 2), np.arange(4))
    assert queries.settle()[1].tolist() == [4.0, 3.0]


def test_license_scan(odd):
    found = {r.doc_id: r for r in license_scan.scanned(odd).collect()}
    assert found[1].n_words == 0 and found[1].labels == "" and found[1].first_word is None
    assert (found[5].n_base, found[5].first_word, found[5].last_word, found[5].base_labels) == (2, 0, 3, "cc-by,mit")


def brute_matches(words):
    """Every template at every beginning where enough of its words stand in place."""
    found = set()
    for t, template in enumerate(license_scan.TEMPLATES):
        wanted = template.text.split()
        size = len(wanted)
        for start in range(-size, len(words)):
            hits = sum(0 <= start + p < len(words) and words[start + p] == w for p, w in enumerate(wanted))
            begin = max(start - license_scan.SLACK, 0)
            inside = f" {' '.join(words[begin: max(start + size + license_scan.SLACK, begin)])} "
            if hits >= 0.6 * size and all(f" {p} " in inside for p in template.phrases):
                found.add((t, start))
    return found


def test_license_matches(spark):
    r = random.Random(7)
    notices = [t.text for t in license_scan.TEMPLATES]
    vocabulary = sorted({w for n in notices for w in n.split()})
    texts = notices * 2 + ["\n".join(notices), " filler ".join(reversed(notices))]
    for _ in range(40):
        words = " ".join(r.sample(notices, 3)).split()
        for _ in range(r.randrange(6)):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        texts.append(" ".join(words[r.randrange(5):]))
    texts += [" ".join(r.choice(vocabulary) for _ in range(300)) for _ in range(5)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x.doc_id: x for x in license_scan.scanned(frame).collect()}
    for k, text in enumerate(texts):
        got = [(m.template, m.start) for m in found[k].matches]
        assert len(got) == len(set(got)) and set(got) == brute_matches(text.split())
    everything = ",".join(sorted({t.label for t in license_scan.TEMPLATES} | {"apache"}))
    assert found[2 * len(notices)].labels == found[2 * len(notices) + 1].labels == everything


def test_license_label_depends_on_the_document_alone(spark):
    text = "apache license version 2 0"
    alone = spark.createDataFrame([(0, text)], "doc_id long, text string")
    others = [t.text for t in license_scan.TEMPLATES] * 3 + ["licensed under licensed under the the"] * 20
    among = spark.createDataFrame([(0, text), *enumerate(others, 1)], "doc_id long, text string")
    found = [license_scan.scanned(docs).where("doc_id = 0").first() for docs in (alone, among)]
    assert found[0] == found[1] and found[0].labels == "apache,apache-2" and found[0].matches[0].start == -3


def test_sentencepiece_round_trip(spark, odd):
    texts = ["a▁b", "  two  spaces ", "日本語 é\n\t\x00", "", None, "word " * 50]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokens = sentencepiece_bpe.encoded(frame)
    back = {r.doc_id: r.text for r in sentencepiece_bpe.decoded(tokens).collect()}
    assert back == dict(enumerate(texts))
    assert {r.lossless for r in sentencepiece_bpe.encoded(odd).collect()} == {True, None}
    plain = {r.doc_id: r.ids for r in sentencepiece_bpe.encoded(frame, dropout=0.0).collect()}
    assert plain[5] != {r.doc_id: r.ids for r in tokens.collect()}[5]


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
    x = (x ^ x >> 27) * 0x94D049BB133111EB % (1 << 64)
    return x ^ x >> 31


def brute_pieces(pieces, unit, skipped):
    """A unit's ids, each candidate asked for on its own; also which were skipped."""
    symbols, gone, asked = list(unit), set(), []
    at = list(range(len(symbols)))
    while True:
        offered = [(pieces.rank[a + b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))
                   if a + b in pieces.rank and (at[k], a, b) not in gone]
        if not offered:
            return [int(k) for k in pieces.ids(symbols)], asked
        k = min(offered)[1]
        asked.append(skipped(len(asked)))
        if asked[-1]:
            gone.add((at[k], symbols[k], symbols[k + 1]))
        else:
            symbols[k: k + 2] = [symbols[k] + symbols[k + 1]]
            del at[k + 1]


def test_sentencepiece_skips_each_candidate():
    pieces = sentencepiece_bpe.load(sentencepiece_bpe.MODEL)
    encoder = sentencepiece_bpe.Encoder(pieces, 0.1, 13)
    r = random.Random(8)
    words = ["international", "understanding", "to", "incomprehensibilities", "ab" * 45, "été", "a" * 30, "日本語"]
    text = " ".join(r.choice(words) for _ in range(4000))
    want, ways, draws = [], set(), []
    start = mixed(77 ^ mixed(13))
    for n, unit in enumerate(sentencepiece_bpe.UNITS.findall(" " + text)):
        key = mixed((n + mixed(start)) % (1 << 64))

        def skipped(j, key=key):
            value = mixed((key + j // 2 * 0x9E3779B97F4A7C15) % (1 << 64))
            return (value >> 32 * (j % 2)) % (1 << 32) < round(0.1 * (1 << 32))

        ids, asked = brute_pieces(pieces, unit.replace(" ", sentencepiece_bpe.SPACE), skipped)
        want += ids
        draws += asked
        if unit == " understanding":
            ways.add(tuple(ids))
    assert encoder.encode(text, 77) == want
    assert len(ways) > 16 and abs(sum(draws) / len(draws) - 0.1) < 0.005


def test_edit_distance(spark):
    r = random.Random(2)
    pairs = []
    for _ in range(200):
        a = [r.choice("ab ") for _ in range(r.randrange(16, 24))]
        b = list(a)
        for _ in range(r.randrange(4)):
            b[r.randrange(len(b))] = r.choice("abc")
        pairs.append(("".join(a), "".join(b[r.randrange(2):])))
    frame = line_dedup.stored(line_dedup.cores(spark.createDataFrame(pairs, "a string, b string").coalesce(1), "a", "b", 2), "cores")
    got = [x[0] for x in frame.select(line_dedup.within_edits(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [distance(a, b) <= 2 for a, b in pairs]


def test_line_dedup(spark, rows):
    docs = [(1, "same line of some length\nfirst"), (2, "same line of sone length\nsecond\n\n"), (3, "first"), (4, None)]
    found = line_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string").withColumn("kept", F.lit(1)))
    assert {r.doc_id: (r.text, r.n_lines, r.n_kept, r.n_near) for r in found.collect()} == {
        1: (docs[0][1], 2, 2, 0), 2: ("second\n\n", 2, 1, 1), 3: ("", 1, 0, 0), 4: (None, 0, 0, 0)}


def test_url_filter(spark):
    urls = ["https://a.example.org/es/1", "http://EXAMPLE.org/en/12", "x", None, "http://ads-track.example.net/a",
            "http://x.com/de/", "http://q.net/login", "http://q.net/docs/login?x", "http://org"]
    found = url_filter.judged(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    assert [(r.host, r.rule, r.verdict) for r in found.orderBy("page_id").collect()] == [
        ("a.example.org", "example.org/es/", "block"), ("example.org", "example.org/en/1", "block"), ("", None, "allow"),
        ("", None, "allow"), ("ads-track.example.net", None, "block"), ("x.com", "com/de/", "block"),
        ("q.net", None, "block"), ("q.net", None, "allow"), ("org", None, "allow")]


def test_url_rules_as_in_the_contract(spark, tmp_path):
    rules = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
             ("com/de/", "block")]
    urls = [f"http://{host}{text}login" for text, _ in rules for host in ("", "a.")] + ["https://example.org/en/2", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    want = {n: rules[n // 2] for n in range(10)} | {10: ("org/", "allow"), 11: (None, "allow")}
    got = queries.op5_url_filter(spark, str(tmp_path)).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in got} == want
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    told = duck.execute(f"SELECT page_id, rule, verdict FROM ({queries.ORACLES['op5_url_filter']})").fetchall()
    assert {k: (rule, verdict) for k, rule, verdict in told} == want


def test_quality_held_out(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    joined = quality.quality_scores(docs, labels, trees=5).join(labels, "doc_id").where("held_out")
    assert joined.where("predicted = quality").count() >= 0.9 * joined.count()


def test_quality_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(odd, none).collect()} == {0.5}


def test_language(spark):
    docs = spark.createDataFrame([(n, t, lang) for n in range(5) for t, lang in (
        ("the cat and the dog of the house", "en"), ("le chat et le chien de la maison", "fr"))], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(1, "http://a.fr/", "<html lang=fr><p>la maison de le chien"), (2, None, None),
                                   (3, "http://b.uk/", "the house of the dog")], "page_id long, url string, html string")
    found = {r.page_id: r.lang for r in language_id.identified(pages, docs).collect()}
    assert (found[1], found[3]) == ("fr", "en") and found[2] is not None
    assert language_id.identified(pages.limit(0), docs).count() == 0


def brute_components(docs):
    sets = []
    for k, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets.append((k, {tuple(words[i: i + 4]) for i in range(max(1, len(words) - 3))} if words else set()))
    root = {k: k for k, _ in sets}
    changed = True
    while changed:
        changed = False
        for a, x in sets:
            for b, y in sets:
                if x and y and 100 * len(x & y) >= 85 * len(x | y) and root[a] < root[b]:
                    root[b], changed = root[a], True
    return sorted(((k, len(x), root[k]) for k, x in sets), key=repr)


def test_jaccard_join(spark, rows):
    r, docs = random.Random(4), []
    for size in (2, 6, 8, 13, 20, 45, 90):
        base = [f"w{r.randrange(900)}" for _ in range(size)]
        for _ in range(9):
            other = list(base)
            for _ in range(r.choice([0, 1, 1, 2])):
                other[r.randrange(size)] = f"w{r.randrange(900)}"
            docs.append((len(docs), " ".join(other)))
    docs += [(900, None), (901, ""), (902, " ")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard_join.linked(frame), "doc_id", "n_shingles", "component_id") == brute_components(docs)


def test_jaccard_long_texts(spark, rows):
    """Long unlike texts of like size, with shared passages, are told apart by their points;
    long linked ones pass, also where their points differ in length."""
    r = random.Random(8)
    prose = lambda n: [f"w{r.randrange(5_000)}" for _ in range(n)]
    passage, texts = prose(40), [prose(n) for n in (3_000, 3_000, 3_050, 3_100, 4_000, 4_200, 1_000)]
    texts = [passage + t for t in texts]
    texts += [texts[0][:2_900], texts[5][:1_000] + ["other"] + texts[5][1_000:], texts[6] + prose(60)]
    texts += [prose(30) for _ in range(2)]
    docs = [(k, " ".join(t)) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard_join.linked(frame), "doc_id", "n_shingles", "component_id") == brute_components(docs)
    keyed = frame.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    classes = jaccard_join.sketches(keyed, 4, 85).cache()
    assert {len(x.point) for x in classes.collect()} >= {128, 256, 512, 1024}
    pairs = classes.alias("x").join(classes.alias("y"), F.col("x.doc_id") < F.col("y.doc_id")).select(
        F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b"))
    name = {x.set_id: x.doc_id for x in classes.collect()}
    left = {(name[x.a], name[x.b]) for x in jaccard_join.passing(pairs, classes, 85).collect()}
    assert left == {(0, 7), (5, 8), (6, 9)}


def test_jaccard_folded_points_bound(spark):
    """Any two points bound what their sets share, whatever their lengths and clipped counts."""
    r = np.random.default_rng(3)
    for n, m, both in ((900, 1_100, 850), (4_000, 4_500, 3_900), (40_000, 41_000, 100), (70_000, 66_000, 66_000)):
        found = r.integers(0, 1 << 63, n + m - both, dtype=np.uint64)
        x, y = (jaccard_join.point_of(f, jaccard_join.dimensions_of(len(f))).tobytes() for f in (found[:n], found[n - both:]))
        for size in (128, min(len(x), len(y))):
            assert jaccard_join.bound(jaccard_join.folded(x, size), jaccard_join.folded(y, size)) >= both
        whole = jaccard_join.point_of(found[:n], 128)
        assert (jaccard_join.folded(x, 128) == whole).all()
        assert jaccard_join.allows(x, y, n, m, 85) >= (100 * both >= 85 * (n + m - both))
    assert not jaccard_join.allows(*(jaccard_join.point_of(r.integers(0, 1 << 63, 40_000, dtype=np.uint64), 8_192).tobytes()
                                     for _ in range(2)), 40_000, 40_000, 85)


def test_jaccard_places_of_copies(spark, rows):
    words = [f"w{i}" for i in range(60)]
    near = words[:59] + ["other"]
    docs = [(k, " ".join(words)) for k in range(5, 45)] + [(3, " ".join(near))] * 2 + [(None, " ".join(words))] * 3
    docs += [(50, None), (51, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("set_id", F.lit("x"))
    found = jaccard_join.linked(frame)
    assert rows(found, "doc_id", "component_id") == sorted(
        [(d, 3 if t else d) for d, t in docs], key=repr)
    keyed = frame.select("doc_id", F.xxhash64("text", F.col("text").isNull()).alias("text_key"), "text")
    filled = jaccard_join.sketches(keyed, 4, 85).where("n_shingles > 0")
    classes = filled.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_key")).alias("pick"))
    places = jaccard_join.class_places(filled, classes)
    # Of 45 rows of two texts, the rows of one document each give places.
    assert places.groupBy("node", "place").count().agg(F.max("count")).first()[0] == 3
    assert places.select("node").distinct().count() == 2


def test_chat(spark):
    chats = [(1, 0, "user", "Hello there my friend.\nHow do you do?"), (1, 1, "assistant", "> hello THERE, my friend\nFine."),
             (1, 2, "user", ">> Hello there my friend.\n> Fine.\nAh."), (2, 0, None, None), (None, 1, "user", "> x\ny")]
    found = chat_format.formatted(spark.createDataFrame(chats, "conv_id long, turn long, role string, text string"))
    assert {(r.conv_id, r.turn): (r.parent, r.root, r.depth, r.text) for r in found.collect()} == {
        (1, 0): (None, 0, 0, chats[0][3]), (1, 1): (0, 0, 1, "Fine."), (1, 2): (0, 0, 1, "Ah."), (2, 0): (None, 0, 0, ""),
        (None, 1): (None, 1, 0, "y")}


def test_chat_short_quotations(spark):
    chats = [(1, 0, "a", "Yes."), (1, 1, "b", "你好，世界"), (1, 2, "c", "Where do we meet?\nOk"), (1, 3, "d", "👍"),
             (1, 4, "e", "> yes\nSure"), (1, 5, "f", "> 你好，世界\n再见"), (1, 6, "g", "> 👍\nFine"),
             (1, 7, "h", "> Ok\n>> yes\nx"), (1, 8, "i", "> sure\n\n> ok\ny"), (1, 9, "j", "> \t\nz"), (1, 4, "e", "again"),
             (None, 0, "k", "Yes."), (2, 5, "l", "> yes\nno")]
    found = chat_format.formatted(spark.createDataFrame(chats, "conv_id long, turn long, role string, text string")).collect()
    got = {(r.conv_id, r.turn): (r.parent, r.root, r.depth, r.place) for r in found}
    assert len(found) == len(chats) and got == {
        (1, 0): (None, 0, 0, 0), (1, 4): (0, 0, 1, 1), (1, 8): (4, 0, 2, 2), (1, 1): (None, 1, 0, 3), (1, 5): (1, 1, 1, 4),
        (1, 2): (None, 2, 0, 5), (1, 7): (2, 2, 1, 6), (1, 3): (None, 3, 0, 7), (1, 6): (3, 3, 1, 8),
        (1, 9): (None, 9, 0, 9), (None, 0): (None, 0, 0, None), (2, 5): (None, 5, 0, 0)}


def test_chat_places_of_a_long_conversation(spark):
    turns = [(c, t % 7, t) for c, n in ((1, 3), (2, 4000), (3, 5)) for t in range(n)]
    frame = spark.createDataFrame(turns, "conv_id long, root long, turn long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(tuple(r) for r in chat_format.reply_places(frame).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = []
    for c in (1, 2, 3):
        want += [(c, t, k) for k, (_, t) in enumerate(sorted((r, t) for x, r, t in turns if x == c))]
    assert got == sorted(want)


def test_decontamination(spark, odd, rows):
    items = spark.createDataFrame([(7, "One, two three. Four five SIX"), (8, "short"), (9, None)], "item_id long, text string")
    found = decontamination.contained_items(odd, items, block_items=1)
    assert rows(found, "doc_id", "item_id", "n_shared") == [(3, 7, 2), (3, 7, 2), (None, 7, 2)]  # none holds "short"
    assert decontamination.decontaminated(odd, items).columns == odd.columns
    assert decontamination.decontaminated(odd, items).count() == len(ODD) - 3


def test_decontamination_short_items(spark, rows):
    r = random.Random(10)
    word = lambda: r.choice("abcdefgh")
    docs = [(k, " ".join(word() for _ in range(r.choice([0, 1, 2, 3, 4, 5, 7, 12, 40])))) for k in range(60)]
    items = [(k, " ".join(word() for _ in range(r.choice([1, 2, 3, 4, 5, 6, 9])))) for k in range(40)]
    items += [(100, docs[-1][1] or "a"), (101, "!"), (102, ""), (103, items[0][1].upper()), (104, None)]

    def grams(words, n):
        return {tuple(words[i: i + n]) for i in range(len(words) - n + 1)}

    want = []
    for d, text in docs:
        for i, item in items:
            words = (item or "").lower().replace("!", "").split()
            if words:
                n = min(5, len(words))
                own = grams(words, n)
                shared = len(own & grams(text.split(), n))
                if 10 * shared >= 8 * len(own):
                    want.append((d, i, shared, len(own)))
    found = lambda **how: decontamination.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), **how)
    columns = ("doc_id", "item_id", "n_shared", "n_item")
    assert any(n < 5 for *_, n in want) and rows(found(), *columns) == sorted(want, key=repr)
    # Blocks bounded by bytes find the same.
    assert rows(found(block_bytes=200), *columns) == sorted(want, key=repr)


def test_decontamination_sql_short_items(spark, rows):
    import duckdb

    from civica.llm.queries import ORACLES
    docs = [(1, "The answer is b"), (2, "b"), (3, "one two three four five six"), (4, ""), (5, "is the B answer")]
    items = [(7, "B"), (8, "answer is"), (9, "one two three four five six"), (10, "?")]
    con = duckdb.connect()
    for name, key, data in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", data)
    want = con.execute(f"SELECT doc_id, item_id, n_shared, n_item FROM ({ORACLES['op10_decontamination']})").fetchall()
    got = decontamination.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got, "doc_id", "item_id", "n_shared", "n_item") == sorted(want, key=repr)
    assert (1, 8, 1, 1) in want and (5, 7, 1, 1) in want and len(want) == 5


def test_clashing_names_in_any_case(spark, rows):
    docs = spark.createDataFrame(
        [(1, "a line of some length here\nx", 7, "p"), (2, "a line of some length here", 8, "q")],
        "doc_id long, text string, N_LINES int, _hit string")
    got = line_dedup.deduplicated(docs)
    assert got.columns == ["doc_id", "text", "_hit", "n_lines", "n_kept", "n_near"]
    assert rows(got, "doc_id", "n_lines", "n_kept", "_hit") == [(1, 2, 2, "p"), (2, 1, 0, "q")]
    items = spark.createDataFrame([(5, "a line of some length here")], "item_id long, text string")
    assert decontamination.decontaminated(docs, items).collect() == []
    assert rows(decontamination.decontaminated(docs, items.limit(0)), "doc_id", "_hit") == [(1, "p"), (2, "q")]


def test_no_documents(spark):
    none = spark.createDataFrame([], TEXT)
    items = spark.createDataFrame([(5, "one two three four five six")], "item_id long, text string")
    for found in (
        license_scan.scanned(none), sentencepiece_bpe.encoded(none), line_dedup.deduplicated(none),
        jaccard_join.linked(none), jaccard_join.one_of_each(none), decontamination.contained_items(none, items),
        decontamination.decontaminated(none, items),
    ):
        assert found.collect() == []
