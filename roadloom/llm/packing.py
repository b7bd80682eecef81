"""Best-fit packing of tokenised documents by a swap-based local search.

Only lengths matter to a packing, and there are at most ``capacity`` of them,
so the search runs over a histogram: a bin is a pattern (a multiset of
lengths) with a multiplicity. The histogram and the patterns are bounded by
the capacity, not by the corpus.

1. Start: patterns are made best-fit decreasing and repeated as long as their
   lengths last.
2. Local search over all underfull patterns: moves and exchanges of up to two
   pieces for up to two that increase the sum of squared fills, each applied
   as often as both patterns last, for at most ``LOOKS`` looks at an exchange.
   Then the ``SEARCH_BINS`` emptiest bins one by one: the emptiest is taken
   apart by moves of its pieces into others' room, one-for-one and two-for-one
   exchanges, until it is empty or no exchange helps.
3. Pieces get places by their rank among the pieces of equal length: the r-th
   piece of a length takes the r-th place that the patterns have for it. Ranks
   come from two levels (rank in a hash bucket, plus the number of pieces in
   earlier buckets). A length has as many buckets as its pieces need for none
   to hold more than about ``BUCKET_ROWS`` of them, nor a ``SHARES``-th of all,
   so no task holds all pieces of a length.

Documents are tokenised once; pieces (without their ids) are written to the
shared folder and read again.

Defined cases: a null or empty text is the end token alone; repeated rows are
packed each on its own; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.llm.base import cut, Lean, slices

CAPACITY, SEPARATOR, SEARCH_BINS, PROBES, LOOKS = 2048, 0, 256, 2_000_000, 300_000_000
BUCKET_ROWS, SHARES = 1_000_000, 256

# Texts of these Latin-1 characters only are cut into words here and looked up; all others go through the tokenizer whole.
PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), 0xA1, 0xAB, 0xBB, 0xBF, *range(0xC0, 0x100)])
LOWER = bytes(c + 32 if 65 <= c <= 90 or 0xC0 <= c <= 0xDE and c != 0xD7 else c for c in range(256))
SPECIAL = b"<|"
PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z\xdf-\xf6\xf8-\xff0-9]+")


class WordTokenizer:
    """Ids of a lower-casing word-level BPE file, with a bounded memory of words; equal to the library's own encoding of whole texts."""

    MOST = 400_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        try:
            plain = text.encode("latin-1")
        except UnicodeEncodeError:
            plain = None
        if plain is None or plain.translate(None, PLAIN) or SPECIAL in plain:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        words = PIECES.findall(plain.translate(LOWER))
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            self.add(words)
            return b"".join(map(self.known.__getitem__, words))

    def add(self, words: list[bytes]) -> None:
        """Encodes the unknown among ``words`` as one text; a word ends with a token that ends words."""
        missing = list(set(words).difference(self.known))
        if len(self.known) + len(missing) > self.MOST:
            self.known.clear()
            missing = list(set(words))
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(missing).decode("latin-1")], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
        whole = ids.tobytes()
        self.known.update(zip(missing, (whole[a:b] for a, b in zip([0, *stops], stops, strict=False)), strict=True))


_LOADED: dict[str, WordTokenizer] = {}


def _pieces(path: str, capacity: int, separator: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokenizer = _LOADED.setdefault(path, WordTokenizer(path)) if path not in _LOADED else _LOADED[path]
    end = int(separator).to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    for whole in batches:
        for batch in slices(whole, "text"):
            doc, piece, start, length, crc = [], [], [], [], []
            for d, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = tokenizer.encode(text) + end if text else end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    doc.append(d)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=names)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(Lean(_pieces, tokenizer, capacity, separator), "doc_id long, piece int, start long, length long, ids_crc32 long")


Bin = list[int]


def start(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with multiplicities, best-fit decreasing."""
    left = {n: c for n, c in histogram.items() if c > 0}
    order = sorted(left)
    out = []
    while order:
        room, pattern = capacity, []
        while True:
            i = bisect_right(order, room) - 1
            while i >= 0 and left[order[i]] <= pattern.count(order[i]):
                i -= 1
            if i < 0:
                break
            take = min(room // order[i], left[order[i]] - pattern.count(order[i]))
            pattern += [order[i]] * take
            room -= take * order[i]
        need = Counter(pattern)
        times = min(left[n] // c for n, c in need.items())
        out.append((tuple(pattern), times))
        for n, c in need.items():
            left[n] -= times * c
        order = [n for n in order if left[n]]
    return out


def exchange(patterns: dict[tuple[int, ...], int], capacity: int, spare: int, looks: int = LOOKS) -> dict[tuple[int, ...], int]:
    """Local search among underfull patterns, which keep their multiplicities: up to two pieces against up to two of another pattern, as often as both last.

    Ends when no exchange increases the sum of squared fills, ``spare`` bins are
    saved, or after ``looks`` looks at an exchange.
    """
    at: dict[tuple[int, ...], int] = {}
    names: list[tuple[int, ...]] = []
    groups: list[dict[int, tuple[int, ...]]] = []
    left, fill, sums, owner = (np.zeros(0, dtype=np.int64) for _ in range(4))
    queue: list[int] = []

    def add(pattern: tuple[int, ...], times: int) -> None:
        nonlocal left, fill, sums, owner
        if pattern not in at:
            at[pattern] = len(groups)
            names.append(pattern)
            few = [n for n, c in Counter(pattern).items() for _ in range(min(c, 2))]
            groups.append({sum(c): c for k in (2, 1, 0) for c in combinations(few, k)})
            left, fill = np.append(left, 0), np.append(fill, sum(pattern))
        i = at[pattern]
        if not left[i]:
            queue.append(i)
            if i not in owner:
                mine = np.array(list(groups[i]), dtype=np.int64)
                sums, owner = np.append(sums, mine), np.append(owner, np.full(len(mine), i))
        left[i] += times

    for pattern, times in sorted(patterns.items(), key=lambda x: (sum(x[0]), x[0])):
        add(tuple(sorted(pattern)), times)
    while queue and spare > 0 and looks > 0:
        a = queue.pop(0)
        while left[a] and spare > 0 and looks > 0:
            if 2 * (left[owner] > 0).sum() < len(owner):
                some = left[owner] > 0
                sums, owner = sums[some], owner[some]
            mine = np.array(list(groups[a]), dtype=np.int64)
            looks -= len(mine) * len(sums)
            grow = sums - mine[:, None]
            fits = (grow <= capacity - fill[a]) & (fill[owner] - grow <= capacity)
            lasts = np.where(owner == a, left[a] // 2, np.minimum(left[a], left[owner]))
            gain = np.where(fits, grow * (grow + fill[a] - fill[owner]), 0) * lasts
            best = int(gain.argmax())
            row, column = divmod(best, len(sums))
            if gain[row, column] <= 0:
                break
            b, times = int(owner[column]), int(lasts[column])
            go, come = groups[a][int(mine[row])], groups[b][int(sums[column])]
            first, second = Counter(names[a]), Counter(names[b])
            left[a] -= times
            left[b] -= times
            for pattern in (first - Counter(go) + Counter(come), second - Counter(come) + Counter(go)):
                if pattern:
                    add(tuple(sorted(pattern.elements())), times)
                else:
                    spare -= times
    return {p: int(left[i]) for p, i in at.items() if left[i]}


def improve(bins: list[Bin], capacity: int, spare: int = 1 << 60, probes: int = PROBES) -> list[Bin]:
    """Local search among underfull bins: takes the emptiest apart while moves and exchanges allow it.

    ``spare`` is how many bins fewer could be reached at all; the search ends
    there, or after ``probes`` looks at a bin.
    """
    bins = sorted((sorted(b) for b in bins), key=sum)
    fixed: list[Bin] = []
    while len(bins) > 1 and spare > 0 and probes > 0:
        others = [list(b) for b in bins[1:]]
        room = [capacity - sum(b) for b in others]
        rest = list(bins[0])
        while rest and probes > 0:
            step = None
            rest.sort()
            for x in reversed(rest):
                fits = [j for j, r in enumerate(room) if x <= r]
                probes -= len(room)
                if fits:  # move, into the bin that it fills best
                    step = (min(fits, key=room.__getitem__), [x], [])
                    break
            if step is None:
                gain = 0
                for x in reversed(rest):  # exchange one for one: the largest gain in squared fill
                    for j, r in enumerate(room):
                        probes -= 1
                        y = next((y for y in others[j] if x - r <= y < x), None)
                        if y is not None and (x - y) * (2 * (capacity - r) + x - y) > gain:
                            gain, step = (x - y) * (2 * (capacity - r) + x - y), (j, [x], [y])
                for k in range(len(rest) - 1):  # two for one, of neighbours in size
                    u = rest[k] + rest[k + 1]
                    for j, r in enumerate(room):
                        probes -= 1
                        y = next((y for y in others[j] if u - r <= y < u), None)
                        if y is not None and (u - y) * (2 * (capacity - r) + u - y) > gain:
                            gain, step = (u - y) * (2 * (capacity - r) + u - y), (j, [rest[k], rest[k + 1]], [y])
            if step is None:
                break
            j, come, go = step
            for x in come:
                rest.remove(x)
            for y in go:
                others[j].remove(y)
            others[j] = sorted(others[j] + come)
            rest += go
            room[j] = capacity - sum(others[j])
        if rest:
            fixed.append(bins.pop(0))
        else:
            bins = sorted(others, key=sum)
            spare -= 1
    return fixed + bins


def plan(histogram: dict[int, int], capacity: int = CAPACITY, most: int = SEARCH_BINS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with multiplicities that hold exactly the histogram's pieces. The search over patterns takes all underfull ones, that over single bins the ``most`` emptiest then; both end when the least possible number of bins is reached."""
    begun = start(histogram, capacity)
    least = -(-sum(n * c for n, c in histogram.items()) // capacity)
    spare = sum(times for _, times in begun) - least
    if spare:
        underfull: Counter[tuple[int, ...]] = Counter()
        for pattern, times in begun:
            if sum(pattern) < capacity:
                underfull[tuple(sorted(pattern))] += times
        begun = [b for b in begun if sum(b[0]) == capacity] + list(exchange(underfull, capacity, spare).items())
        spare = sum(times for _, times in begun) - least
    begun.sort(key=lambda x: sum(x[0]))
    loose: list[Bin] = []
    kept = []
    for pattern, times in begun:
        taken = min(times, most - len(loose)) if sum(pattern) < capacity and spare else 0
        loose += [list(pattern)] * taken
        if times > taken:
            kept.append((pattern, times - taken))
    return kept + [(tuple(b), 1) for b in improve(loose, capacity, spare)]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the runs of its places: first rank, first sequence, offset; a run's r-th rank is its r-th sequence."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    ranks: Counter[int] = Counter()
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for n in pattern:
            runs.setdefault(n, []).append((ranks[n], sequence, offset))
            ranks[n] += times
            offset += n
        sequence += times
    return {n: tuple(np.array(x, dtype=np.int64) for x in zip(*r, strict=True)) for n, r in runs.items()}


def _place(where: dict[int, tuple[np.ndarray, ...]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        order = np.argsort(length, kind="stable")
        edges = np.flatnonzero(np.diff(length[order])) + 1
        for rows in np.split(order, edges) if len(order) else []:
            first, seq, off = where[int(length[rows[0]])]
            run = np.searchsorted(first, rank[rows], side="right") - 1
            sequence[rows] = seq[run] + rank[rows] - first[run]
            offset[rows] = off[run]
        names = [n for n in batch.schema.names if n != "_rank"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])


def buckets_of(histogram: dict[int, int], rows: int = BUCKET_ROWS, shares: int = SHARES) -> dict[int, int]:
    """How many buckets a length's pieces are dealt out over; the sum is at most the number of lengths, plus ``shares`` or the pieces over ``rows``."""
    size = max(1, min(rows, sum(histogram.values()) // shares))
    return {length: -(-n // size) for length, n in histogram.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, separator: int = SEPARATOR, rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cutup = cut(pieces(docs, tokenizer, capacity, separator), "pieces")
    # Bounded: a row for each length, capacity at most.
    histogram = {int(length): int(n) for length, n in cutup.groupBy("length").agg(F.count("*").alias("n")).collect()}
    of = np.ones(capacity + 1, dtype=np.int64)
    for length, n in buckets_of(histogram, rows).items():
        of[length] = n
    deal = F.pmod(F.xxhash64("doc_id", "piece"), F.element_at(F.split(F.lit(",".join(map(str, of.tolist()))), ",").cast("array<long>"), F.col("length").cast("int") + 1))
    bucketed = cutup.withColumn("_bucket", deal.cast("int"))
    # Bounded by the sum of buckets_of().
    counted = sorted((int(a), int(b), int(c)) for a, b, c in bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("n")).collect())
    before: Counter[int] = Counter()
    lift = []
    for length, bucket, n in counted:
        lift.append((length, bucket, before[length]))
        before[length] += n
    where = places(plan(histogram, capacity))
    spark = docs.sparkSession
    lifts = spark.createDataFrame(lift, "l long, b int, lift long")
    inside = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = bucketed.withColumn("_in", inside).join(F.broadcast(lifts), (F.col("length") == F.col("l")) & (F.col("_bucket") == F.col("b")))
    placed = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_in") + F.col("lift")).cast("long").alias("_rank"))
    return placed.mapInArrow(Lean(_place, where), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
