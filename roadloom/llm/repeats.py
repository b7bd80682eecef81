"""Removal of long repeated byte strings by sparse suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
anywhere else. The result is exact; the suffixes that are sorted are a sparse,
content-defined subset of all:

1. Anchors. A position is an anchor if its ``GRAM``-byte string has the least
   hash in some window of ``LENGTH`` bytes (all ties are). Two equal windows
   have the same anchors at the same places, so it is enough to compare
   windows around anchors. There is about one anchor in 90 bytes.
2. Runs of equal halves. A window of 200 bytes holds the 100 bytes right of its
   anchor or the 100 bytes left of it. Anchors are dealt out by the hashes of
   those halves; an anchor that shares neither is done with. One that shares
   its whole neighbourhood (200 bytes each way) is repeated throughout. Within
   a slice of the input equal halves are collapsed before the exchange, so a
   passage that a third of all documents hold sends one row a slice.
3. Merge sort. What is left goes on as suffixes: the half's hash, then the text
   leading away from it. Tasks sort their suffixes into runs, front-code them
   (shared prefix length and rest), and exchange blocks by ranges of the hash;
   each range is merged by a loser tree that carries the known common prefix
   lengths and compares bytes only behind them. Neighbours in the merged order
   that share the half are compared for how far they agree on either side.
   Halves with more than ``GROUP`` suffixes are not merged in one task: their
   windows are hashed one by one and counted by a distributed aggregation.

Defined cases: a null or empty text has no bytes and keeps none (the hash is
that of no bytes); texts under 200 bytes lose nothing; repeated rows are
repeats of each other and go altogether; matches are judged on the input, so
all copies go; a row without doc_id matches nothing and loses nothing; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.base import cut, Lean, mix64, slices, spread, texts

LENGTH, GRAM, HALF, GROUP, SLICE = 200, 16, 100, 100_000, 1_000_000

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_BYTES = np.random.default_rng(31).integers(1, 2**64, size=256, dtype=np.uint64)
_SALT = {"R": _U(0x1B873593CC9E2D51), "L": _U(0x2545F4914F6CDD1D)}


class Prefix:
    """Hashes of any substring of a buffer, from one running sum."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self.down = np.full(n + 1, _U(_INVERSE))
        self.down[0] = 1
        np.multiply.accumulate(self.down, out=self.down)
        up = np.full(n, _U(_BASE))
        if n:
            up[0] = 1
            np.multiply.accumulate(up, out=up)
            up *= _BYTES[buf]
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(up, out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix64((self.sums[stop] - self.sums[start]) * self.down[start])


def _slide(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of x[i : i + width]; the result is shorter by width - 1."""
    f, size = (np.minimum if least else np.maximum), 1
    while 2 * size <= width:
        x = f(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return f(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(buf: np.ndarray, bounds: np.ndarray, prefix: Prefix) -> np.ndarray:
    """Anchor positions in a buffer of documents that lie between ``bounds``."""
    n = len(buf)
    if n < LENGTH:
        return np.zeros(0, dtype=np.int64)
    width = LENGTH - GRAM + 1
    raw = (prefix.sums[GRAM:] - prefix.sums[:-GRAM]) * prefix.down[: n - GRAM + 1]
    h = (mix64(raw) >> _U(33)).astype(np.uint32) + np.uint32(1)
    ends = bounds[1:]
    left = np.zeros(n + 1, dtype=np.int32)  # bytes from here to the document's end
    lengths = np.diff(bounds)
    left[:n] = np.repeat(ends, lengths) - np.arange(n)
    h[left[: len(h)] < GRAM] = np.uint32(2**32 - 1)
    window = _slide(h, width, least=True)
    window = np.where(left[: len(window)] >= LENGTH, window, np.uint32(0))
    reach = _slide(np.concatenate((np.zeros(width - 1, dtype=np.uint32), window, np.zeros(width - 1, dtype=np.uint32))), width, least=False)
    return np.flatnonzero(reach[: len(h)] == h)


# What an anchor's row says. NORMAL: look for partners. REP: repeated throughout, and stands for its like. BEACON: only tells others that the half exists. CANDIDATE and SURE need no look.
NORMAL, REP, BEACON, CANDIDATE, SURE = range(5)


def _rows(slice_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", slice_bytes):
            docs = texts(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            bounds = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int64)
            buf = np.frombuffer(b"".join(docs), dtype=np.uint8)
            prefix = Prefix(buf)
            x = anchors(buf, bounds, prefix)
            if not len(x):
                continue
            of = np.searchsorted(bounds, x, side="right") - 1
            lo, hi = bounds[of], bounds[of + 1]
            pos = x - lo
            l, r = np.minimum(pos, LENGTH), np.minimum(hi - x, LENGTH)
            around = mix64(prefix.of(x - l, x + r) + (l * 512 + r).astype(np.uint64))
            has_r, has_l = np.flatnonzero(r >= HALF), np.flatnonzero(l >= HALF)
            key = np.concatenate((mix64(prefix.of(x[has_r], x[has_r] + HALF) ^ _SALT["R"]), mix64(prefix.of(x[has_l] - HALF, x[has_l]) ^ _SALT["L"])))
            at = np.concatenate((has_r, has_l))
            kind = np.concatenate((np.zeros(len(has_r), dtype=np.int64), np.ones(len(has_l), dtype=np.int64)))
            f = around[at].view(np.int64)
            order = np.lexsort((f, key))
            key, at, kind, f = key[order], at[order], kind[order], f[order]
            new_key = np.concatenate(([True], key[1:] != key[:-1]))
            new_f = new_key | np.concatenate(([True], f[1:] != f[:-1]))
            run, sub = np.cumsum(new_key) - 1, np.cumsum(new_f) - 1
            sub_size, run_subs = np.bincount(sub), np.bincount(run[new_f])
            state = np.where(sub_size[sub] > 1, np.where(new_f, REP, SURE), NORMAL)
            mixed = run_subs[run] > 1
            # In a half with several neighbourhoods each is a candidate already; the first stays behind as a beacon.
            extra = np.flatnonzero(mixed & new_key)
            sure_too = np.flatnonzero(mixed & new_f & (state == REP))
            state = np.where(mixed & new_f, CANDIDATE, state)
            rows = np.concatenate((np.arange(len(at)), extra, sure_too))
            state = np.concatenate((state, np.full(len(extra), BEACON), np.full(len(sure_too), SURE)))
            key, at, kind, f = key[rows], at[rows], kind[rows], f[rows]
            doc, p = ids[of[at]], pos[at]
            # An anchor that is repeated within the slice is so on both sides; with both halves, one side says it.
            rows = np.flatnonzero(~((kind == 1) & (r[at] >= HALF) & (state == SURE)))
            key, kind, f, doc, p, state = key[rows], kind[rows], f[rows], doc[rows], p[rows], state[rows]
            info = (p << 4) | (kind << 3) | state
            route = np.where(state >= CANDIDATE, mix64((doc.astype(np.uint64) << _U(20)) + p.astype(np.uint64)), key)
            yield pa.RecordBatch.from_arrays([pa.array(route.view(np.int64)), pa.array(key.view(np.int64)), pa.array(f), pa.array(doc, pa.int64()), pa.array(info)], names=["route", "key", "f", "doc_id", "info"])


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, pos, kind, sure): anchors repeated throughout, and candidates."""
    got = [tuple(b.column(c).to_numpy() for c in ("key", "f", "doc_id", "info")) for b in batches if b.num_rows]
    if not got:
        return
    key, f, doc, info = (np.concatenate(c) for c in zip(*got, strict=True))
    state, kind, pos = info & 7, (info >> 3) & 1, info >> 4
    sure, cand = state == SURE, state == CANDIDATE
    looks = np.flatnonzero(state < CANDIDATE)
    if len(looks):
        looks = looks[np.lexsort((state[looks] == BEACON, f[looks], key[looks]))]
        k, s, g = key[looks], state[looks], f[looks]
        new_k = np.concatenate(([True], k[1:] != k[:-1]))
        beacon = s == BEACON
        new_g = new_k | np.concatenate(([True], (g[1:] != g[:-1]) | (beacon[1:] != beacon[:-1])))
        run, sub = np.cumsum(new_k) - 1, np.cumsum(new_g) - 1
        whole = ~beacon & ((np.bincount(sub)[sub] > 1) | (s == REP))
        several = np.bincount(run[new_g])[run] > 1
        sure[looks] = whole
        cand[looks] = ~beacon & several & new_g
    for mask, flag in ((sure, True), (cand, False)):
        rows = np.flatnonzero(mask)
        if len(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[rows]), pa.array(doc[rows]), pa.array(pos[rows].astype(np.int32)), pa.array(kind[rows].astype(np.int32)), pa.array(np.full(len(rows), flag))],
                names=["key", "doc_id", "pos", "kind", "sure"],
            )


def suffix(text: bytes, pos: int, kind: int) -> tuple[bytes, bytes, int, int]:
    """The text leading away from the half on its open side, the text behind the half, and how many bytes of each exist. Padding bytes occur in no UTF-8."""
    left = text[max(0, pos - LENGTH) : pos][::-1]
    right = text[pos : pos + LENGTH]
    main, other = (left[:HALF], right[HALF:]) if kind == 0 else (right[:HALF], left[HALF:])
    return main.ljust(HALF, b"\xff"), other.ljust(HALF, b"\xff"), len(main), len(other)


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, given that ``start`` bytes are known to agree."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    lo, hi = start, n  # a[:lo] agree, a[:hi] don't
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def front_code(run: list[tuple[bytes, bytes]]) -> bytes:
    """A sorted run of (string, payload) as shared prefix lengths and rests."""
    out, last = [], b""
    for s, payload in run:
        shared = common(last, s)
        out.append(shared.to_bytes(2, "little") + (len(s) - shared).to_bytes(2, "little") + len(payload).to_bytes(2, "little") + s[shared:] + payload)
        last = s
    return b"".join(out)


def front_decode(blocks: Iterator[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
    """(prefix shared with the one before, string, payload); every block begins anew."""
    last = b""
    for block in blocks:
        at, prev = 0, b""
        while at < len(block):
            shared, rest, size = (int.from_bytes(block[at + i : at + i + 2], "little") for i in (0, 2, 4))
            at += 6
            s = prev[:shared] + block[at : at + rest]
            payload = block[at + rest : at + rest + size]
            at += rest + size
            yield (shared if prev else common(last, s)), s, payload
            prev = last = s


class LoserTree:
    """Merges sorted runs of (shared, string, payload). Each string comes with the length of the prefix it shares with the last winner; of two strings the one that shares more is less, and bytes are compared behind that length only."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes, bytes]]]):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.string: list[bytes | None] = [None] * self.size
        self.payload: list[bytes] = [b""] * self.size
        self.shared = [0] * self.size
        for i, run in enumerate(runs):
            item = next(run, None)
            if item:
                self.string[i], self.payload[i] = item[1], item[2]
        self.losers = [0] * self.size
        self.winner = self._build(1)

    def _duel(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared length becomes that with the winner."""
        x, y = self.string[a], self.string[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        p, q = self.shared[a], self.shared[b]
        if p > q:
            return a, b
        if q > p:
            return b, a
        both = common(x, y, p)
        if x[both:] <= y[both:]:
            self.shared[b] = both
            return a, b
        self.shared[a] = both
        return b, a

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        w, loser = self._duel(self._build(2 * node), self._build(2 * node + 1))
        self.losers[node] = loser
        return w

    def __iter__(self) -> Iterator[tuple[int, bytes, bytes]]:
        while self.string[self.winner] is not None:
            i = self.winner
            yield self.shared[i], self.string[i], self.payload[i]
            item = next(self.runs[i], None) if i < len(self.runs) else None
            if item:
                self.shared[i], self.string[i], self.payload[i] = item
            else:
                self.string[i] = None
            w, node = i, (i + self.size) // 2
            while node:
                w, self.losers[node] = self._duel(w, self.losers[node])
                node //= 2
            self.winner = w


def _header(key: int, kind: int) -> bytes:
    return (key & (2**64 - 1)).to_bytes(8, "big") + bytes([kind])


def _runs(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted, front-coded runs in blocks, by range of the half's hash."""
    held: list[tuple[bytes, bytes]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        held.sort()
        run = int.from_bytes(hashlib.blake2b(held[0][0] + held[0][1] + held[-1][1], digest_size=7).digest(), "big")
        part, seq, block = [], [], []
        at = 0
        of = [int.from_bytes(s[:8], "big") * parts >> 64 for s, _ in held]
        while at < len(held):
            stop = at
            while stop < len(held) and of[stop] == of[at] and stop - at < 500:
                stop += 1
            part.append(of[at])
            seq.append(at)
            block.append(front_code(held[at:stop]))
            at = stop
        held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([run] * len(part), pa.int64()), pa.array(seq, pa.int32()), pa.array(block, pa.binary())], names=["part", "run", "seq", "block"])

    for batch in batches:
        for doc, text, asked in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), batch.column("asked").to_pylist(), strict=True):
            for a in asked:
                main, other, m, o = suffix(text, a["pos"], a["kind"])
                held.append((_header(a["key"], a["kind"]) + main, other + bytes([m, o]) + doc.to_bytes(8, "little", signed=True) + a["pos"].to_bytes(4, "little")))
                size += 1
            if size >= 40_000:
                yield from flush()
                size = 0
    if held:
        yield from flush()


def extents(main: list[bytes], other: list[bytes], has_main: np.ndarray, has_other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes of one half: the least and greatest number of bytes on the open side of a repeated window (greatest -1: none)."""
    n = len(main)
    low, high = np.full(n, HALF + 1), np.full(n, -1)
    same: dict[bytes, list[int]] = {}
    for i in range(n):
        same.setdefault(main[i] + other[i], []).append(i)
    for rows in same.values():
        if len(rows) > 1:
            i = rows[0]
            if has_main[i] + has_other[i] >= HALF:
                low[rows], high[rows] = HALF - has_other[i], has_main[i]
    if len(same) == 1:
        return low, high
    first = np.array([rows[0] for rows in same.values()])
    lo, hi = _distinct([main[i] for i in first], [other[i] for i in first], has_main[first], has_other[first])
    for rows, a, b in zip(same.values(), lo.tolist(), hi.tolist(), strict=True):
        if b >= 0:
            low[rows], high[rows] = np.minimum(low[rows], a), np.maximum(high[rows], b)
    return low, high


def _distinct(main: list[bytes], other: list[bytes], has_main: np.ndarray, has_other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(main)
    low, high = np.full(n, HALF + 1), np.full(n, -1)
    if n <= 3:
        for i in range(n):
            for j in range(i):
                a, b = common(main[i], main[j]), HALF - common(other[i], other[j])
                for k in (i, j):
                    top, bottom = min(a, int(has_main[k])), max(b, HALF - int(has_other[k]))
                    if bottom <= top:
                        low[k], high[k] = min(low[k], bottom), max(high[k], top)
        return low, high
    m = np.frombuffer(b"".join(main), dtype=np.uint8).reshape(n, HALF)
    o = np.frombuffer(b"".join(other), dtype=np.uint8).reshape(n, HALF)
    if n <= 128:
        def agree(x: np.ndarray) -> np.ndarray:
            differ = x[:, None, :] != x[None, :, :]
            return np.where(differ.any(axis=2), differ.argmax(axis=2), HALF)

        top = np.minimum(agree(m), has_main[:, None])
        bottom = HALF - np.minimum(agree(o), has_other[:, None])
        fits = bottom <= top
        np.fill_diagonal(fits, False)
        return np.where(fits, bottom, HALF + 1).min(axis=1), np.where(fits, top, -1).max(axis=1)
    powers = np.full(HALF, _U(_BASE))
    np.multiply.accumulate(powers, out=powers)
    hm = np.zeros(n, dtype=np.uint64)
    ho = (_BYTES[o] * powers).sum(axis=1, dtype=np.uint64) if n <= 4096 else sum(_BYTES[o[:, j]] * powers[j] for j in range(HALF))
    for a in range(HALF + 1):
        ok = np.flatnonzero((has_main >= a) & (has_other >= HALF - a))
        if len(ok) > 1:
            h = mix64(hm[ok] ^ mix64(ho[ok] + _U(7)))
            order = np.argsort(h, kind="stable")
            equal = h[order][1:] == h[order][:-1]
            twice = ok[order[np.concatenate((equal, [False])) | np.concatenate(([False], equal))]]
            low[twice] = np.minimum(low[twice], a)
            high[twice] = np.maximum(high[twice], a)
        if a < HALF:
            hm += _BYTES[m[:, a]] * powers[a]
            ho -= _BYTES[o[:, HALF - a - 1]] * powers[HALF - a - 1]
    return low, high


def _span(kind: np.ndarray, pos: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.where(kind == 0, pos - high, pos - LENGTH + low), np.where(kind == 0, pos + LENGTH - low, pos + high)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, start, stop) of repeated stretches, from the merged order of each range."""
    runs: dict[int, dict[int, list[bytes]]] = {}
    for batch in batches:
        for part, run, block in zip(batch.column("part").to_pylist(), batch.column("run").to_pylist(), batch.column("block").to_pylist(), strict=True):
            runs.setdefault(part, {}).setdefault(run, []).append(block)
    for blocks in runs.values():
        doc, start, stop = [], [], []

        def close(group: list[tuple[bytes, bytes]], doc: list = doc, start: list = start, stop: list = stop) -> None:
            kind = group[0][0][8]
            p = [x[1] for x in group]
            low, high = extents([x[0][9:] for x in group], [x[:HALF] for x in p], np.array([x[HALF] for x in p]), np.array([x[HALF + 1] for x in p]))
            pos = np.array([int.from_bytes(x[HALF + 10 : HALF + 14], "little") for x in p])
            a, b = _span(np.full(len(p), kind), pos, low, high)
            for i in np.flatnonzero(high >= 0):
                doc.append(int.from_bytes(p[i][HALF + 2 : HALF + 10], "little", signed=True))
                start.append(int(a[i]))
                stop.append(int(b[i]))

        group: list[tuple[bytes, bytes]] = []
        for shared, s, payload in LoserTree([front_decode(iter(b)) for b in blocks.values()]):
            if group and shared < 9:
                if len(group) > 1:
                    close(group)
                group = []
            group.append((s, payload))
        if len(group) > 1:
            close(group)
        if doc:
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(stop, pa.int64())], names=["doc_id", "start", "stop"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, doc_id, pos, kind, a): every window of the suffixes of crowded halves, hashed. Windows that meet in one slice go on as one row, and that they are repeated is said at once (rows without h)."""
    powers = np.full(HALF, _U(_BASE))
    np.multiply.accumulate(powers, out=powers)
    for batch in batches:
        rows = []
        for doc, text, asked in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), batch.column("asked").to_pylist(), strict=True):
            rows += [(doc, x["pos"], x["kind"], x["key"], *suffix(text, x["pos"], x["kind"])) for x in asked]
        for at in range(0, len(rows), 20_000):
            part = rows[at : at + 20_000]
            n = len(part)
            doc, pos, kind = (np.array([r[i] for r in part], dtype=np.int64) for i in range(3))
            key = np.array([r[3] for r in part], dtype=np.int64).view(np.uint64) + kind.astype(np.uint64)
            m = np.frombuffer(b"".join(r[4] for r in part), dtype=np.uint8).reshape(n, HALF)
            o = np.frombuffer(b"".join(r[5] for r in part), dtype=np.uint8).reshape(n, HALF)
            has_main, has_other = np.array([r[6] for r in part]), np.array([r[7] for r in part])
            hm = np.zeros(n, dtype=np.uint64)
            ho = sum(_BYTES[o[:, j]] * powers[j] for j in range(HALF))
            for a in range(HALF + 1):
                ok = np.flatnonzero((has_main >= a) & (has_other >= HALF - a))
                h = mix64(key[ok] + mix64(hm[ok] ^ mix64(ho[ok] + _U(7))) + _U(a))
                order = np.argsort(h, kind="stable")
                ok, h = ok[order], h[order]
                again = np.concatenate(([False], h[1:] == h[:-1])) if len(h) else np.zeros(0, dtype=bool)
                more = np.concatenate((again[1:], [False])) if len(h) else again
                for pick, told in ((~again, True), (again | more, False)):
                    some = ok[pick]
                    if len(some):
                        hashes = pa.array(h[pick].view(np.int64)) if told else pa.nulls(len(some), pa.int64())
                        yield pa.RecordBatch.from_arrays([hashes, pa.array(doc[some]), pa.array(pos[some]), pa.array(kind[some].astype(np.int32)), pa.array(np.full(len(some), a, dtype=np.int64))], names=["h", "doc_id", "pos", "kind", "a"])
                if a < HALF:
                    hm += _BYTES[m[:, a]] * powers[a]
                    ho -= _BYTES[o[:, HALF - a - 1]] * powers[HALF - a - 1]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for text, spans in zip(texts(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
            kept, removed, runs, at = [], 0, 0, 0
            last = -1
            for s in sorted((x["start"], x["stop"]) for x in spans or []):
                a, b = max(s[0], at), min(s[1], len(text))
                if b > a:
                    if s[0] > last:
                        runs += 1
                    kept.append(text[at:a])
                    removed += b - a
                    at = last = b
            kept.append(text[at:])
            for column, v in zip(out, (len(text), removed, runs, hashlib.sha256(b"".join(kept)).hexdigest()), strict=True):
                column.append(v)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())], names=names)


def repeated_spans(docs: DataFrame, group: int = GROUP, slice_bytes: int = SLICE) -> DataFrame:
    """(doc_id, start, stop): stretches of repeated bytes; they overlap."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    rows = base.filter(F.octet_length("text") >= LENGTH).mapInArrow(Lean(_rows, slice_bytes), "route long, key long, f long, doc_id long, info long")
    marked = cut(spread(rows, "route").select("key", "f", "doc_id", "info").mapInArrow(Lean(_partners), "key long, doc_id long, pos int, kind int, sure boolean"), "anchors")
    sure = marked.filter("sure").select("doc_id", F.greatest(F.col("pos") - LENGTH, F.lit(0)).cast("long").alias("start"), (F.col("pos") + LENGTH).cast("long").alias("stop"))
    cands = marked.filter("not sure")
    # Few halves are crowded, mostly none: then there is nothing to join them with.
    crowded = cut(cands.groupBy("key", "kind").agg(F.count("*").alias("n")).filter(F.col("n") > group).select("key", "kind", F.lit(True).alias("crowded")), "crowded")
    none = crowded.isEmpty()
    told = cands.withColumn("crowded", F.lit(None).cast("boolean")) if none else cands.join(crowded, ["key", "kind"], "left")
    asked = told.groupBy("doc_id").agg(F.collect_set(F.struct("key", "pos", "kind", "crowded")).alias("all"))
    work = base.join(asked, "doc_id")
    few = work.select("doc_id", "text", F.filter("all", lambda x: x["crowded"].isNull()).alias("asked")).filter(F.size("asked") > 0)
    many = work.select("doc_id", "text", F.filter("all", lambda x: x["crowded"].isNotNull()).alias("asked")).filter(F.size("asked") > 0)
    parts = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    runs = few.mapInArrow(Lean(_runs, parts), "part int, run long, seq int, block binary")
    merged = spread(runs, "part").sortWithinPartitions("part", "run", "seq").mapInArrow(Lean(_merge), "doc_id long, start long, stop long")
    spans = sure.unionByName(merged)
    if not none:
        windows = cut(many.mapInArrow(Lean(_windows), "h long, doc_id long, pos long, kind int, a long"), "windows")
        twice = windows.filter("h is not null").groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
        hit = windows.join(twice, "h", "left_semi").unionByName(windows.filter("h is null"))
        hit = hit.groupBy("doc_id", "pos", "kind").agg(F.min("a").alias("low"), F.max("a").alias("high"))
        right = F.col("kind") == 0
        spans = spans.unionByName(hit.select("doc_id", F.when(right, F.col("pos") - F.col("high")).otherwise(F.col("pos") - LENGTH + F.col("low")).alias("start"), F.when(right, F.col("pos") + LENGTH - F.col("low")).otherwise(F.col("pos") + F.col("high")).alias("stop")))
    return spans


def remove_repeats(docs: DataFrame, group: int = GROUP, slice_bytes: int = SLICE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Spans have LENGTH bytes or more, so those that start within LENGTH bytes of each other overlap and are one: a document has one for each LENGTH bytes at most.
    near = spread(repeated_spans(docs, group, slice_bytes), "doc_id").groupBy("doc_id", F.floor(F.col("start") / LENGTH).alias("near")).agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    by_doc = near.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return base.join(by_doc, "doc_id", "left").mapInArrow(Lean(_remove), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
