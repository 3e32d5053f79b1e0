"""The pipeline's stages against brute force, each on its own input, and as a whole."""

import random
import re

import corpus_pipeline
from civica.llm import sentencepiece_bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def corpus():
    """Prose with exact and near copies, shared lines, benchmark passages, and odd rows."""
    r = random.Random(6)
    words = ["".join(r.choice("abcdefghijklmno") for _ in range(r.randint(2, 7))) for _ in range(500)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [prose(14) for _ in range(4)]
    texts = ["\n".join(prose(12) for _ in range(5)) for _ in range(30)]
    texts += [texts[0], texts[1], texts[1] + "\n" + prose(3)]
    near = texts[2].split(" ")
    near[len(near) // 2] = "changed"
    texts += [" ".join(near), prose(20) + "\n" + texts[3].split("\n")[0], prose(30) + " " + items[0] + " " + prose(10), items[1]]
    texts += [None, "", " \n\t", "short", "日本語 text"]
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    return rows + [rows[5]], [(k, x) for k, x in enumerate(items)]


def tables(spark, folder):
    rows, items = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(k, int(k % 7 != 0), 0) for k in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs, rows, items


def as_rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def shingles(text, pattern):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(pattern, low)
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages(spark, tmp_path):
    docs, rows, items = tables(spark, str(tmp_path))
    run = lambda name: STAGES[name](spark, docs, str(tmp_path))
    for name in list(STAGES)[:-1]:
        assert run(name).columns == docs.columns, name

    # Rows leave whole, and what is left is as it was.
    kept = as_rows(run("quality"))
    assert set(kept) <= set(rows) and len(kept) > len(rows) // 2

    # Near duplicates: the smallest (doc_id, text) of each linked group, every copy of its row.
    sets = {k: shingles(t, r"[^\x20\x09-\x0D]+") for k, t, *_ in rows}
    root = {k: k for k in sets}

    def find(k):
        return k if root[k] == k else find(root[k])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = [row for row in rows if not sets[row[0]] or find(row[0]) == row[0]]
    assert as_rows(run("near_duplicates")) == sorted(want, key=repr)
    assert len(want) < len(rows) - 3

    # Decontamination: no item with at least 0.8 of its shingles in the document.
    alnum = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    wanted = [shingles(t, alnum) for _, t in items]
    want = [row for row in rows if not any(10 * len(s & shingles(row[1], alnum)) >= 8 * len(s) for s in wanted)]
    assert as_rows(run("decontamination")) == sorted(want, key=repr) and len(want) == len(rows) - 2

    # Tokens: a row for each row, and the text comes back.
    tokens = run("tokens")
    back = as_rows(sentencepiece_bpe.decoded(tokens))
    assert back == sorted(((k, t) for k, t, *_ in rows), key=repr)
    assert {x.lossless for x in tokens.collect()} == {True, None}


def near(a, b):
    """Whether two lines are equal, or of 16 characters and more and within two edits."""
    if a == b or min(len(a), len(b)) < 16 or abs(len(a) - len(b)) > 2:
        return a == b
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1] <= 2


def test_line_stage(spark):
    """Classes, the first line of each and the texts that are left, by all pairs of lines."""
    r = random.Random(9)
    base = ["".join(r.choice("abcd ") for _ in range(r.choice([5, 15, 16, 17, 30, 200]))).strip() for _ in range(12)]
    lines = []
    for line in base:
        for _ in range(r.randint(1, 5)):
            x = list(line)
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                if x:
                    x[r.randrange(len(x))] = r.choice("abcd")
            lines.append("".join(x).strip())
    texts = ["\n".join(r.choice([*lines, ""]) for _ in range(r.randint(1, 6))) for _ in range(25)] + [None, "", "\n"]
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
    distinct = sorted({x for t in texts if t for x in t.split("\n") if x})
    root = {x: x for x in distinct}

    def find(x):
        return x if root[x] == x else find(root[x])

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if find(a) != find(b) and near(a, b):
                root[find(a)] = find(b)
    want, seen = [], set()
    for k, text, *rest in rows:
        if text is None:
            want.append((k, None, "en", "s", None))
            continue
        left, filled, stayed = [], 0, 0
        for x in text.split("\n"):
            filled += bool(x)
            if x and find(x) in seen:
                continue
            stayed += bool(x)
            if x:
                seen.add(find(x))
            left.append(x)
        if not filled or stayed:
            want.append((k, "\n".join(left), "en", "s", len("\n".join(left))))
    got = STAGES["line_dedup"](spark, spark.createDataFrame(rows, SCHEMA), "")
    assert as_rows(got) == sorted(want, key=repr)


def test_whole_run_and_empty_tables(spark, tmp_path):
    tables(spark, str(tmp_path / "a"))
    found = corpus_pipeline.run(spark, str(tmp_path / "a"))
    assert found.columns == ["doc_id", "ids", "n_ids", "lossless"]
    back = {k: t for k, t in (tuple(x) for x in sentencepiece_bpe.decoded(found).collect())}
    given = {k: t for k, t, *_ in corpus()[0]}
    assert set(back) < set(given) and {30, 31, 35, 36}.isdisjoint(back)
    assert all(set((back[k] or "").split("\n")) <= set((given[k] or "").split("\n")) for k in back)
    empty = spark.createDataFrame([], SCHEMA)
    for name in ("line_dedup", "near_duplicates", "tokens"):
        assert STAGES[name](spark, empty, "").count() == 0
    assert STAGES["decontamination"](spark, empty, str(tmp_path / "a")).count() == 0
