"""Toxicity, decontamination, nearest neighbours and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadloom.llm import ann, decontaminate, toxicity
from tests.llm.data import documents, frame, words
from tests.llm.test_minhash import brute as near_brute


def labelled(seed=0, n=400):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = words(rng, 60).split()
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["wretched", "scoundrel", "zorg" + rng.choice("abcdef")]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def lexicon(spark):
    docs, labels = labelled()
    return toxicity.learn(toxicity.fit_sample(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")))


def test_lexicon(lexicon):
    assert {"wretched", "scoundrel"} <= set(lexicon["words"]) and "zorg" in lexicon["stems"]


def test_held_out(spark, lexicon):
    docs, labels = labelled(9, 200)
    got = {r.doc_id: r.score for r in toxicity.score(frame(spark, docs), lexicon).collect()}
    assert all((got[i] >= toxicity.THRESHOLD) == bool(y) for i, y in labels)


def test_misspellings_quotes_and_nulls(spark, lexicon):
    clean = "w1x w2x w3x w4x w5x w6x w7x w8x w9x "
    rows = [(1, clean + "wretchd scoundrell"), (2, clean + 'he said "wretched"'), (3, clean + "you wretched"), (4, None), (5, ""), (6, clean + "wr3tched sc0undrel"), (7, clean), (8, clean + "wretched"), (9, clean + "wrethced scuondrel")]
    s = {r.doc_id: r.score for r in toxicity.score(frame(spark, rows), lexicon).collect()}
    assert s[2] < toxicity.THRESHOLD < s[8] < s[3]
    assert min(s[1], s[6], s[9]) >= toxicity.THRESHOLD
    assert s[4] == s[5] == s[7] == 0


def test_automaton_is_edit_distance():
    def distance(a, b):
        d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    rng = random.Random(1)
    some = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 6)))
    lexicon = sorted({some() for _ in range(30)})
    root = toxicity.trie(lexicon)
    for _ in range(300):
        w = some()
        for most in (1, 2):
            near = min(((distance(w, x), x) for x in lexicon if distance(w, x) <= most), default=None)
            assert toxicity.within(w, root, most) == (near[1] if near else None)


def test_one_misspelling_is_enough():
    stem, word, long = "grumbl", "wretched", "abominations"
    m = toxicity.Matcher({"words": {word: 0.7, long: 0.7}, "stems": {stem: 0.7}, "fuzzy": {word: toxicity.FUZZY, long: toxicity.FUZZY, stem + "*": toxicity.FUZZY}})
    for text in ["wretchd", "wrethced", "wr3tched", "grunblers", "grumb1ing", "abxminatiyns", "bominatinos"]:
        assert m.score(f"w1x w2x {text} w3x") >= toxicity.THRESHOLD, text
    for text in ['he said "wretchd"', "grabbing", "w4x"]:
        assert m.score(f"w1x w2x {text} w3x") < toxicity.THRESHOLD, text


def test_prefilter_is_exact():
    rng = random.Random(4)
    some = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    for _ in range(4000):
        term = some(rng.randint(5, 16)) + rng.choice(["", "*"])
        most, w = toxicity.edits_of(term), list(term.rstrip("*"))
        for _ in range(most):
            i = rng.randrange(len(w) - 1)
            w[i : i + 2] = rng.choice([[w[i + 1], w[i]], [w[i + 1]], ["x", w[i + 1]], [w[i], "x", w[i + 1]]])
        word = "".join(w) + ("tail" if term.endswith("*") else "")
        if toxicity.within(word, toxicity.trie([term]), most):
            assert toxicity.Pieces([term], most).match(word)


def test_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    empty = toxicity.learn(toxicity.fit_sample(frame(spark, [(1, "a b")]), none))
    assert [r.score for r in toxicity.score(frame(spark, [(1, "a b")]), empty).collect()] == [0.0]
    assert toxicity.score(frame(spark, []), empty).collect() == []


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment():
    rng = np.random.default_rng(0)
    for _ in range(100):
        a, b = (rng.integers(0, 5, rng.integers(1, 20)).astype(np.uint64) for _ in range(2))
        score, start, stop = decontaminate.align(a, b)
        assert score == smith_waterman(a.tolist(), b.tolist())
        if score:
            assert smith_waterman(a.tolist(), b[start:stop].tolist()) == score


def test_contamination(spark):
    rng = random.Random(2)
    items = [(i, words(rng, 40)) for i in range(20)] + [(20, "Only two"), (21, ""), (22, None), (23, "solitary")]
    rows, want = documents(8), set()
    for k in range(60):
        item = items[k % 20][1].split()
        edited = [f"edit{rng.randrange(999)}" if rng.random() < 0.12 * (k % 3) else w for w in item]
        if k % 4 == 0:
            edited.insert(5, "inserted")
        rows.append((9000 + k, words(rng, 80) + " , " + " ".join(edited).upper() + " ; " + words(rng, 80)))
        want.add((9000 + k, k % 20))
    rows.append((9999, "here only TWO here"))
    for block_bytes in (8_000_000, 1500):
        got = decontaminate.contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want | {(9999, 20)}
    assert decontaminate.contaminated(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).collect() == []
    assert decontaminate.contaminated(frame(spark, rows), spark.createDataFrame([], "item_id long, text string")).collect() == []


@pytest.mark.parametrize("kind", ["edited", "half"])
def test_many_partial_copies_beside_one_whole(spark, kind):
    rng = random.Random(5)
    item = words(rng, 40, 10**6).split()
    part = item[:20] if kind == "half" else [f"edit{k}" if k in (6, 14, 22, 30) else w for k, w in enumerate(item)]
    rows = [(1, "before " + " ".join(item) + " after")] + [(10 + k, words(rng, 30) + " " + " ".join(part) + " " + words(rng, 30)) for k in range(100)]
    got = decontaminate.contaminated(frame(spark, rows), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert {r.doc_id for r in got} == {i for i, _ in rows}


def test_short_item_with_a_common_phrase(spark):
    rng = random.Random(6)
    item = "alpha beta gamma delta"
    rows = [(k, words(rng, 30) + f" {item} " + words(rng, 30)) for k in range(5)] + [(100 + k, words(rng, 30) + " beta gamma delta " + words(rng, 30)) for k in range(495)]
    got = decontaminate.contaminated(frame(spark, rows), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert set(range(5)) <= {r.doc_id for r in got}


def vectors(n=1500, size=16):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, size))
    x = centers[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, size))
    x[200:500] = x[200]  # one vector over and over
    rows = [(i, x[i].astype(np.float32).tolist()) for i in range(n)]
    rows += [(n, None), (n + 1, [0.0] * size), (n + 2, [float("nan")] * size), (n + 3, [None] * size), (n + 4, [float("inf")] + [1.0] * (size - 1)), (n + 5, []), (n + 6, [1.0, 2.0])]
    return rows + [rows[0], rows[7]]


@pytest.mark.parametrize("visit", [None, 600])
def test_recall(spark, visit):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit("clash"))
    got = ann.search(df, df.filter("vec_id % 20 = 0"), top=10, visit=visit, unit=100).collect()
    good = {i: np.array(v, dtype=np.float64) for i, v in rows[:1500]}
    ids = np.array(sorted(good))
    x = np.array([good[i] for i in ids])
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {i for i in range(0, 1500, 20)}
    hits = 0
    for q, answers in found.items():
        answers.sort()
        assert [a[0] for a in answers] == list(range(1, 11))
        assert [(s, v) for _, v, s in answers] == sorted((s, v) for _, v, s in answers)
        assert all(s == pytest.approx(np.sqrt(((good[v] - good[q]) ** 2).sum()), abs=1e-12) and v != q for _, v, s in answers)
        d = np.sqrt(((x - good[q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, d))[:10]].tolist()) & {v for _, v, _ in answers})
    assert hits >= 0.9 * 10 * len(found)


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = ann.search(df, df, top=10).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 2), (0, 1), (1, 2), (1, 0), (2, 0), (2, 1)]
    assert ann.search(df.filter("false"), df.filter("false"), top=10).collect() == []


def test_each_length_has_its_index(spark):
    rng = np.random.default_rng(4)
    good = {i: rng.normal(size=3 if i % 7 == 0 else 8 if i % 3 else 1) for i in range(300)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in good.items()], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df, df.filter("vec_id % 20 = 0"), top=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    own = lambda q: [i for i in good if i != q and len(good[i]) == len(good[q])]
    assert got == {q: sorted(own(q), key=lambda i: (np.sqrt(((good[i] - good[q]) ** 2).sum()), i))[:4] for q in range(0, 300, 20)}


def test_pipeline_stages(spark, tmp_path):
    """Each stage against what brute force says of its input."""
    rng = random.Random(11)
    docs, labels = labelled(3, 300)
    item = words(rng, 40)
    docs = [(i, t) for i, t in docs] + [(1000 + i, t) for i, t in documents(12) if t is not None and len(t) < 50_000]
    docs += [(50_000, words(rng, 30) + " " + item + " " + words(rng, 30)), (50_001, words(rng, 60) + " password=abcdef123456"), (50_002, None)]
    d = str(tmp_path)
    frame(spark, docs, extra=False).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    state = spark.read.parquet(f"{d}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = state.columns
        path = f"{d}/{name}"
        stage(spark, state, d).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == before
        seen.append((name, sorted((r.doc_id, r.text or "") for r in state.collect()), sorted((r.doc_id, r.text or "") for r in after.collect())))
        state = after
    by = {name: (a, b) for name, a, b in seen}
    a, b = by["toxicity"]
    toxic = {i for i, y in labels if y}
    assert {i for i, _ in a} - {i for i, _ in b} == toxic
    a, b = by["near_dedup"]
    want = near_brute(a, 5)
    assert b == sorted({(i, t) for i, t in a if want[i][1] == i or not t})
    a, b = by["decontaminate"]
    assert {i for i, _ in a} - {i for i, _ in b} == {50_000}
    a, b = by["secrets"]
    assert [i for i, _ in a] == [i for i, _ in b] and [t for i, t in b if i == 50_001][0].endswith("[assign]") and sum(x != y for x, y in zip(a, b, strict=True)) == 1
    packed = corpus_pipeline.run(spark, d).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in b}


def test_decontamination_recall_against_full_alignment(spark):
    """Of all pairs that a full Smith-Waterman alignment puts at the threshold, nearly all are found, and no others; every third word replaced included."""
    rng = random.Random(12)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(k, [rng.choice(vocabulary) for _ in range(rng.randint(18, 60))]) for k in range(8)]

    def edited(w, kind):
        w = list(w)
        if kind in (3, 4):  # every third, every fourth word replaced
            w[kind - 1 :: kind] = [f"e{rng.randrange(10**6)}" for _ in w[kind - 1 :: kind]]
        elif kind == 5:  # half of the item
            w = w[: len(w) // 2]
        else:
            for _ in range(rng.randrange(len(w) // 3)):
                i = rng.randrange(len(w))
                w[i : i + 1] = rng.choice([[], [rng.choice(vocabulary)], [w[i], f"e{rng.randrange(10**6)}"]])
        return w

    docs = [(i, [rng.choice(vocabulary) for _ in range(40)] + edited(items[i % 8][1], i % 7) + [rng.choice(vocabulary) for _ in range(30)]) for i in range(160)]
    docs += [(1000 + i, [rng.choice(vocabulary) for _ in range(120)]) for i in range(60)]
    made = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, [(i, " ".join(w)) for i, w in docs]), made).collect()}
    number = {w: n for n, w in enumerate(sorted({w for _, ws in docs + items for w in ws}))}
    code = lambda ws: np.array([number[w] for w in ws], dtype=np.uint64)
    want = {(i, k) for i, d in docs for k, item in items if decontaminate.align(code(item), code(d))[0] >= decontaminate.THRESHOLD * decontaminate.MATCH * len(item)}
    assert any(i % 7 == 3 for i, _ in want) and len(want) > 120
    assert got <= want and len(got) >= 0.98 * len(want)
