"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased. A seed is three words, next
to each other or with one left out before the last (so a copy whose every third
word was replaced still holds seeds). Every seed of a benchmark item is counted
in the whole corpus. A passage with seeds of an item at ``SEEDS`` different
places (all, if it has fewer) within the item's length is aligned with the item by words (match 2, mismatch -1, gap -1). The
score is the alignment's, divided by that of a perfect copy; ``THRESHOLD`` and
above is a copy, edited or not.

No seed is left out for its count. An item's rare seeds are all but its
``SEEDS`` - 1 most frequent ones: a passage with enough seeds holds one of
them, so documents are looked up by rare seeds only, and the others are added
where a rare one was found. A passage that shares too few words with the item
to reach the threshold at all is not aligned. No number of partners is capped;
a document is aligned where it is read, so documents with many hits stay in
their own row and there is no shuffle of texts at all.

The benchmark is taken in blocks of about ``BLOCK_BYTES`` of text, each of
which goes with the tasks; its size is measured first, so what is shipped is
bounded whatever the benchmark's size.

Defined cases: null and empty texts and items match nothing; an item without a
full seed (under three words) is its own single seed; repeated rows and items
are reported each; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.base import cut, Lean, mix64, slices, texts
from roadloom.llm.shingles import word_hashes

SEED_WORDS, GAPPED, SEEDS, THRESHOLD, BLOCK_BYTES = 3, (0, 1, 3), 2, 0.4, 8_000_000
PAIRS = 4_000_000
MATCH, MISMATCH, GAP = 2, -1, -1

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_BITS = 20


def words_of(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes([d.translate(_PLAIN) for d in docs])


def shapes(n: int) -> list[tuple[int, ...]]:
    """The seeds of an item of n words, each by the places of its words from the first."""
    return [tuple(range(max(1, min(n, SEED_WORDS))))] + ([GAPPED] if n > GAPPED[-1] else [])


def seeds_of(words: np.ndarray, shape: tuple[int, ...] = tuple(range(SEED_WORDS))) -> np.ndarray:
    """Hash of the words of ``shape`` at each place where it fits."""
    n = len(words) - shape[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = words[:n] + _U(shape[-1])
    for j in shape[1:]:
        h = h * _STEP + words[j : n + j]
    return mix64(h)


class Index:
    """Seeds of a block of items: sorted hashes, and for each the (item, place) pairs it stands at."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in items]
        hashed, at = words_of([t for _, t in items])
        self.words = [hashed[at[i] : at[i + 1]] for i in range(len(items))]
        own = [[seeds_of(w, shape) for shape in shapes(len(w))] for w in self.words]
        self.seeds = [np.concatenate(s) for s in own]
        self.places = [np.concatenate([np.arange(len(x)) for x in s]).tolist() for s in own]
        # Passages are told by seeds of one shape; the other one only adds to them.
        self.need = [min(SEEDS, len(set(s[0].tolist()))) for s in own]
        self.reach = np.array([len(w) + len(w) // 2 + 4 for w in self.words], dtype=np.int64)
        self.hashes = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *self.seeds]))
        self.filter = np.zeros(1 << _BITS, dtype=bool)
        self.filter[(self.hashes & _U((1 << _BITS) - 1)).astype(np.int64)] = True
        self.shapes = sorted({shape for w in self.words for shape in shapes(len(w))})
        self.use({})

    def use(self, counts: dict[int, int]) -> None:
        """Split the items' seeds into rare and other ones by ``counts``."""
        count = np.array([counts.get(h, 0) for h in self.hashes.tolist()], dtype=np.int64)
        rare, other = [], []
        for i, s in enumerate(self.seeds):
            numbers = np.searchsorted(self.hashes, s).tolist()
            often = set(sorted(set(numbers), key=lambda k: (-count[k], k))[: max(0, self.need[i] - 1)])
            for q, k in zip(self.places[i], numbers, strict=True):
                (other if k in often else rare).append((k, i, q))
        table = np.array(sorted(rare), dtype=np.int64).reshape(-1, 3)
        self.at = np.searchsorted(table[:, 0], np.arange(len(self.hashes) + 1))
        self.rare = table[:, 1:]
        table = np.array(sorted(other, key=lambda r: r[1:]), dtype=np.int64).reshape(-1, 3)
        self.other_at = np.searchsorted(table[:, 1], np.arange(len(self.ids) + 1))
        self.other = table[:, ::2]

    def pairs(self, doc: np.ndarray, place: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, ...]:
        """(doc, item, place, place in the item) of hits, by doc, item and place, for all docs and items with a rare seed."""
        hit, row = spread(self.at[number], self.at[number + 1])
        n = max(1, len(self.ids))
        key, p, q = doc[hit] * n + self.rare[row, 0], place[hit], self.rare[row, 1]
        # The items' other seeds, only in the documents that hold a rare one.
        some = np.unique(key)
        which, row = spread(self.other_at[some % n], self.other_at[some % n + 1])
        order = np.lexsort((place, number, doc))
        k = len(self.hashes) + 1
        known, want = (doc * k + number)[order], some[which] // n * k + self.other[row, 0]
        ask, found = spread(np.searchsorted(known, want), np.searchsorted(known, want, side="right"))
        key = np.concatenate([key, some[which][ask]])
        p, q = np.concatenate([p, place[order][found]]), np.concatenate([q, self.other[row, 1][ask]])
        order = np.lexsort((q, p, key))
        return key[order] // n, key[order] % n, p[order], q[order]

    def hits(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the seed) of all indexed seeds in a buffer of documents' words."""
        places, numbers = [], []
        if not len(self.hashes):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for shape in self.shapes:
            h = seeds_of(words, shape)
            if not len(h):
                continue
            at = np.flatnonzero(self.filter[(h & _U((1 << _BITS) - 1)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
            good = self.hashes[k] == h[at]
            at, k = at[good], k[good]
            inside = np.searchsorted(bounds, at, side="right") == np.searchsorted(bounds, at + shape[-1], side="right")
            places.append(at[inside])
            numbers.append(k[inside])
        if not places:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        place, number = np.concatenate(places), np.concatenate(numbers)
        order = np.argsort(place, kind="stable")
        return place[order], number[order]


def spread(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges: the number of the range and the place, for each place in them."""
    size = stop - start
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + start[which]


def chunks(doc: np.ndarray, weight: np.ndarray, most: int = PAIRS) -> Iterator[slice]:
    """Slices of whole documents' hits, of at most ``most`` pairs unless a document has more by itself."""
    at, total = 0, np.cumsum(weight)
    while at < len(doc):
        stop = int(np.searchsorted(total, (total[at - 1] if at else 0) + most, side="right"))
        stop = int(np.searchsorted(doc, doc[stop])) if stop < len(doc) else len(doc)
        if stop <= at:
            stop = int(np.searchsorted(doc, doc[at], side="right"))
        yield slice(at, stop)
        at = stop


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and where it starts and stops in the window (words)."""
    n = len(window)
    steps = np.arange(n + 1)
    row, origin = np.zeros(n + 1, dtype=np.int64), steps.copy()
    best = (0, 0, 0)
    for w in item:
        diagonal = row[:-1] + np.where(window == w, MATCH, MISMATCH)
        up = row + GAP
        new, source = np.zeros(n + 1, dtype=np.int64), steps.copy()
        better = diagonal > 0
        new[1:][better] = diagonal[better]
        source[1:][better] = origin[:-1][better]
        better = up > new
        new[better], source[better] = up[better], origin[better]
        # Gaps along the window: the running best, less one a step.
        lifted = new - GAP * steps
        top = np.maximum.accumulate(lifted)
        where = np.maximum.accumulate(np.where(lifted == top, steps, 0))
        along = top + GAP * steps
        better = along > new
        new[better] = along[better]
        source[better] = source[where[better]]
        row, origin = new, source
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), int(origin[j]), j)
    return best


def _count(index: Index, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(len(index.hashes), dtype=np.int64)
    for whole in batches:
        for batch in slices(whole, "text", 2_000_000):
            words, at = words_of(texts(batch.column("text")))
            _, numbers = index.hits(words, at)
            total += np.bincount(numbers, minlength=len(total))
    some = np.flatnonzero(total)
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(index.hashes[some].view(np.int64)), pa.array(total[some])], names=["seed", "n"])


def _copies(index: Index, threshold: float, ids: list, words: np.ndarray, at: np.ndarray, doc: np.ndarray, item: np.ndarray, p: np.ndarray, q: np.ndarray) -> list[tuple]:
    """Rows for the documents and items whose best passage reaches the threshold."""
    if not len(doc):
        return []
    # A passage: hits that follow each other within the item's reach.
    first = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(p) > index.reach[item[1:]])]))
    stop = np.append(first[1:], len(doc))
    least, most = np.minimum.reduceat(p - q, first), np.maximum.reduceat(p - q, first)
    need = np.array(index.need)[item[first]]
    full = (need < 2) | (np.minimum.reduceat(q, first) < np.maximum.reduceat(q, first))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for g in np.flatnonzero(full).tolist():
        d, i = int(doc[first[g]]), int(item[first[g]])
        if len(set(q[first[g] : stop[g]].tolist())) < need[g]:
            continue
        w = index.words[i]
        lo = max(int(at[d]), int(least[g]) - len(w) // 2 - 4)
        hi = min(int(at[d + 1]), int(most[g]) + len(w) + len(w) // 2 + 4)
        window = words[lo:hi]
        if np.isin(w, window).sum() / len(w) < threshold:
            continue  # the score is at most the share of the item's words that occur here
        score, a, b = align(w, window)
        share = score / (MATCH * len(w))
        if share >= threshold and share > best.get((d, i), (0.0, 0, 0))[0]:
            best[d, i] = (share, lo + a - int(at[d]), lo + b - int(at[d]))
    return [(ids[d], index.ids[i], *b) for (d, i), b in best.items()]


def _find(index: Index, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 2_000_000):
            ids = batch.column("doc_id").to_pylist()
            words, at = words_of(texts(batch.column("text")))
            place, number = index.hits(words, at)
            doc = np.searchsorted(at, place, side="right") - 1
            rows = []
            for part in chunks(doc, index.at[number + 1] - index.at[number]):
                rows += _copies(index, threshold, ids, words, at, *index.pairs(doc[part], place[part], number[part]))
            if rows:
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "score", "first_word", "end_word"])


SCHEMA = "doc_id long, item_id long, score double, first_word long, end_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, score, first_word, end_word (exclusive): every document that holds a copy of an item."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    out = None
    for b in range(blocks):
        # Bounded: about block_bytes of text.
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id").collect()
        index = Index([(r[0], r[1].encode()) for r in mine])
        counts = base.mapInArrow(Lean(_count, index), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect()
        index.use({int(s) & (2**64 - 1): int(n) for s, n in counts})
        found = cut(base.mapInArrow(Lean(_find, index, threshold), SCHEMA), "contaminated")
        out = found if out is None else out.unionByName(found)
    return out
