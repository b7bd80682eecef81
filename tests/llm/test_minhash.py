import re

import numpy as np
import pytest

from roadloom.llm import base
from roadloom.llm.minhash import near_duplicates
from roadloom.llm.shingles import overlap, shingle_sets
from tests.llm.data import documents, frame


def sets_of(text, k):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent=80):
    s = {i: sets_of(t, k) for i, t in rows}
    ids = sorted(s)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if s[a] and s[b]:
                both = len(s[a] & s[b])
                if 100 * both >= percent * (len(s[a]) + len(s[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("k", "block"), [(2, 256), (5, 256), (2, 8)])
def test_brute_force(spark, k, block):
    rows = documents()
    got = near_duplicates(frame(spark, rows), k=k, block=block).collect()
    want = brute(rows, k)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_empty_and_idless(spark):
    assert near_duplicates(frame(spark, []), k=2).collect() == []
    got = near_duplicates(frame(spark, [(None, "a b c"), (1, "a b c"), (None, None)]), k=2).collect()
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in got if r.doc_id) == [(False, 1, True)]
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)


def test_sets_and_overlap():
    a, b = shingle_sets([b"a b c d", b"B C\tD e"], 2)
    assert len(a) == 3 and len(b) == 3 and overlap(a, b) == 2
    assert overlap(a, np.zeros(0, dtype=np.uint64)) == 0
    long = b"x" * 5000
    assert len(np.intersect1d(*shingle_sets([long + b"1", long + b"2"], 1))) == 0


def test_components_of_chains(spark):
    import random

    order = list(range(300))
    random.Random(3).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(0, 299) if i % 50 != 49] + [(5, 5), (order[0], order[1])]
    got = {r.node: r.root for r in base.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for i, x in enumerate(order):
        groups.setdefault(got[x], set()).add(i // 50)
    assert len(groups) == 6 and all(len(g) == 1 for g in groups.values())


def test_hot_group_with_outsiders(spark):
    """A large group of copies, and documents that meet it on some coordinates without being linked, or only to each other."""
    import random

    rng = random.Random(21)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]

    def edited(n):
        out = list(base)
        for i in rng.sample(range(len(out)), n):
            out[i] = f"e{rng.randrange(10**6)}"
        return out

    rows = [(i, " ".join(edited(3))) for i in range(60)]
    far = edited(14)
    rows += [(100 + i, " ".join(edited(14))) for i in range(20)] + [(200, " ".join(far)), (201, " ".join(far[:-1] + ["last"]))]
    want = brute(rows, 2)
    assert len({c for _, c in want.values()}) > 1
    got = near_duplicates(frame(spark, rows), k=2, block=8).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_boilerplate_hardly_meets(spark):
    """Documents that share a template and are not similar enough collide often, but few of them become pairs."""
    import random

    from pyspark.sql import functions as F

    from roadloom.llm.minhash import _pairs_by_prefix

    rng = random.Random(8)
    template = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join(template + [f"o{rng.randrange(10**5)}" for _ in range(rng.choice([60, 120, 200]))])) for i in range(4000)]
    rows += [(5000 + i, " ".join(rows[i][1].split()[:-4])) for i in range(20)]
    docs = frame(spark, rows, extra=False)
    bodies = docs.select("doc_id", "text", (F.size(F.split("text", " ")) - 1).cast("long").alias("n"))
    pairs = _pairs_by_prefix(docs.select("doc_id", F.col("doc_id").alias("comp")), bodies, 2, 80, 4096)
    assert {(i, 5000 + i) for i in range(20)} <= {(r.a, r.b) for r in pairs.collect()}
    assert pairs.count() < 2000  # of eight million
    got = near_duplicates(docs, k=2).filter("not kept").collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(5000 + i, i) for i in range(20)}


def test_meet_loses_no_similar_pair():
    """Of random sets under one order of tokens: pairs at the threshold meet at the first shared token."""
    import random

    from roadloom.llm.minhash import meet

    rng = random.Random(5)
    core = list(range(1000, 1060))
    sets = [sorted(set(rng.sample(core, rng.randrange(40, 60)) + rng.sample(range(1000), rng.randrange(12)))) for _ in range(120)]
    met = set()
    for token in {t for s in sets for t in s}:
        who = [i for i, s in enumerate(sets) if token in s]
        n, pos = (np.array(x, dtype=np.int64) for x in ([len(sets[i]) for i in who], [sets[i].index(token) for i in who]))
        a, b = meet(np.array(who), np.array(who), n, pos, np.zeros(len(who), dtype=np.int64), 80)
        met |= {(min(p), max(p)) for p in zip(a.tolist(), b.tolist(), strict=True)}
    similar = {(i, j) for j in range(120) for i in range(j) if 180 * len(set(sets[i]) & set(sets[j])) >= 80 * (len(sets[i]) + len(sets[j]))}
    assert similar and similar <= met


def test_recall_at_the_threshold():
    """Of planted pairs at similarity 0.80 to 0.82 all but a negligible share collide on enough coordinates."""
    from roadloom.llm.minhash import MATCHES, signatures

    rng = np.random.default_rng(3)
    lost = 0
    for _ in range(40):
        sets = []
        for _ in range(50):
            both, more = rng.integers(0, 2**63, size=164, dtype=np.uint64), rng.integers(0, 2**63, size=40, dtype=np.uint64)
            sets += [np.unique(np.concatenate((both, more[:20]))), np.unique(np.concatenate((both, more[20:])))]
        sig = signatures(sets)
        lost += int(((sig[::2] == sig[1::2]).sum(axis=1) < MATCHES).sum())
    assert lost == 0
