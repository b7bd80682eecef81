import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from roadloom.llm import repeats
from tests.llm.data import documents, frame


def brute(rows):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, d in texts:
        for i in range(len(d) - 199):
            seen[d[i : i + 200]] += 1
    out = []
    for k, d in texts:
        gone = bytearray(len(d))
        end = -1
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                a = max(i, end)
                gone[a : i + 200] = b"\x01" * (i + 200 - a)
                end = i + 200
        kept = bytes(c for c, f in zip(d, gone, strict=True) if not f)
        spans = sum(1 for i, f in enumerate(gone) if f and (i == 0 or not gone[i - 1]))
        out.append((k, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def mixed(seed):
    rng = random.Random(seed)
    some = lambda n, a="abcdefgh é": "".join(rng.choice(a) for _ in range(n))
    blocks = [some(rng.randint(150, 500)) for _ in range(20)]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 6)):
            b = rng.choice(blocks)
            a = rng.randint(0, len(b))
            parts.append(rng.choice([b, b[a : rng.randint(a, len(b))], some(rng.randint(0, 300))]))
        rows.append((i, "".join(parts)))
    line = some(60) + "\n"
    rows += [(900, None), (901, ""), (902, "a" * 1000), (903, "ab" * 300), (904, line * 20), (905, "a" * 199), (906, "é" * 500), (907, (line * 20)[5:300])]
    passage = some(450)
    return rows + [(1000 + i, some(rng.randint(50, 400)) + passage + some(rng.randint(50, 400))) for i in range(150)]


@pytest.mark.parametrize("slice_bytes", [1_000_000, 3_000, 1])
@pytest.mark.parametrize("group", [100_000, 4])
def test_brute_force(spark, group, slice_bytes):
    """Groups over 128 suffixes, (with a small bound) the crowded path, and copies in one slice or in several."""
    rows = mixed(1)
    got = sorted(map(tuple, repeats.remove_repeats(frame(spark, rows), group, slice_bytes).collect()))
    assert got == brute(rows)


def test_copies_over_slices(spark):
    """Pairs of copies that meet others of their passage in their own slice on one side of an anchor only."""
    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = some(900)
    docs = [some(rng.randint(0, 180)) + passage[rng.randint(0, 300) :] + some(rng.randint(0, 60)) for _ in range(60)]
    docs += [docs[i] for i in rng.sample(range(60), 30)]
    rng.shuffle(docs)
    rows = list(enumerate(docs))
    for slice_bytes in (2_000, 20_000):
        got = sorted(map(tuple, repeats.remove_repeats(frame(spark, rows), slice_bytes=slice_bytes).collect()))
        assert got == brute(rows)


def test_awkward_documents(spark):
    rows = documents(1)
    got = sorted(map(tuple, repeats.remove_repeats(frame(spark, rows)).collect()))
    assert got == brute(rows)
    assert repeats.remove_repeats(frame(spark, [])).collect() == []


def test_loser_tree_merges():
    rng = random.Random(5)
    runs = [sorted(("".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode(), bytes([k])) for _ in range(rng.randint(0, 40))) for k in range(5)]
    coded = [repeats.front_decode(iter([repeats.front_code(r[:7]), repeats.front_code(r[7:])])) if r else iter(()) for r in runs]
    got = list(repeats.LoserTree(coded))
    assert [s for _, s, _ in got] == sorted(s for r in runs for s, _ in r)
    for (_, a, _), (shared, b, _) in zip(got, got[1:], strict=False):
        assert shared == repeats.common(a, b)


def test_anchor_in_every_window():
    rng = np.random.default_rng(2)
    buf = np.concatenate((rng.integers(97, 101, 3000), np.full(500, 97), rng.integers(97, 123, 700))).astype(np.uint8)
    bounds = np.array([0, 1500, 1600, len(buf)])
    x = repeats.anchors(buf, bounds, repeats.Prefix(buf))
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        for s in range(lo, hi - 199):
            assert ((x >= s) & (x <= s + 184)).any()
