"""MinHash near-duplicates by a signature-coordinate inverted join.

Every distinct shingle set gets a signature of ``COORDS`` coordinates; one
coordinate is the tuple of ``ROWS`` independent minima. (A single minimum of a
common shingle is shared by a fixed share of all documents, so its posting
list would grow with the corpus and its pairs with the square; a tuple is
shared by near-duplicates only.) A document is posted under the first
``COORDS - MATCHES + 1`` of its (coordinate, value) pairs: two documents that
agree on ``MATCHES`` coordinates must meet in that prefix. Identical sets are
collapsed to their least document first.

Nothing is concluded from a collision alone: a link is a pair with ``MATCHES``
collisions, counted over both whole signatures, whose full sets are similar
enough. Lists are worked on in rounds, and what is connected is skipped:

1. In a round every list with documents of several components compares its
   leader (the least by a hash that is another one in each round) with the
   documents of other components. That is linear in the postings, connects a
   large group of copies, and is repeated while it connects much.
2. Lists that still have several components are merged by prefix: their
   documents are keyed once more by their rarest shingles, as many as a
   partner must share one of, and only those that meet there in places that
   leave room for enough overlap are pairs; their collisions are counted and
   their sets compared. So documents that share a template, which collide and
   are not similar enough, mostly never meet. A key with many documents is cut
   into blocks of ``BLOCK``, a pair of blocks a unit of work. Pairs are met in
   arrays in a task; only those that pass the filters become rows.

Recall: at similarity 0.8 a coordinate agrees with probability 0.41, so a pair
has fewer than 2 of 36 agreements with probability 1.5e-7; all else is exact.

Defined cases: null or empty text and text without words has an empty set and
is linked with nothing; repeated rows are identical sets and all of them are
returned; a row without doc_id takes no part and is returned with a null
component; further columns of the input are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.base import components, cut, grouped, Lean, mix64, slices, spread, texts
from roadloom.llm.shingles import overlap, shingle_sets

COORDS, ROWS, MATCHES, BLOCK = 36, 4, 2, 4096
# Documents that a leader is compared with in one unit of work; rounds of leaders at most, and the share of open documents that a round must connect for another one.
UNIT, ROUNDS, WORTH = 256, 4, 0.05

_U = np.uint64
_RNG = np.random.default_rng(777)
_A = _RNG.integers(0, 2**64, size=COORDS * ROWS, dtype=np.uint64) | _U(1)
_B = _RNG.integers(0, 2**64, size=COORDS * ROWS, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of COORDS values for each (non-empty) set."""
    flat = np.concatenate(sets)
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.zeros((len(sets), COORDS), dtype=np.uint64)
    for c in range(COORDS):
        value = np.full(len(sets), c + 1, dtype=np.uint64)
        for r in range(c * ROWS, (c + 1) * ROWS):
            value = mix64(value * _U(0x9E3779B97F4A7C15) + np.minimum.reduceat(flat * _A[r] + _B[r], at))
        out[:, c] = value
    return out


def _sign(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 1_500_000):
            sets = shingle_sets(texts(batch.column("text")), k)
            full = [i for i, s in enumerate(sets) if len(s)]
            coords: list = [None] * len(sets)
            f1, f2 = np.zeros(len(sets), dtype=np.uint64), np.zeros(len(sets), dtype=np.uint64)
            if full:
                some = [sets[i] for i in full]
                sig = signatures(some)
                at = np.concatenate(([0], np.cumsum([len(s) for s in some])[:-1]))
                flat = np.concatenate(some)
                f1[full] = np.add.reduceat(mix64(flat + _U(11)), at)
                f2[full] = np.add.reduceat(mix64(flat ^ _U(0xABCDEF1234567)), at)
                for row, i in enumerate(full):
                    coords[i] = sig[row].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(f1.view(np.int64)),
                    pa.array(f2.view(np.int64)),
                    pa.array(coords, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "f1", "f2", "coords"],
            )


def _confirm(k: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each unit's leader with the unit's other documents."""
    for unit in grouped(batches, "unit"):
        unit = unit.combine_chunks()
        at = int(np.argmax(unit.column("leads").to_numpy(zero_copy_only=False)))
        ids, n = unit.column("doc_id").to_numpy(), unit.column("n").to_numpy()
        sig = np.asarray(unit.column("coords").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(len(ids), COORDS)
        fits = ((sig == sig[at]).sum(axis=1) >= MATCHES) & (100 * np.minimum(n, n[at]) >= percent * np.maximum(n, n[at]))
        fits[at] = False
        some = np.append(np.flatnonzero(fits), at)
        if len(some) == 1:
            continue
        sets = shingle_sets(texts(unit.column("text").combine_chunks().take(pa.array(some))), k)
        both = np.array([overlap(s, sets[-1]) for s in sets[:-1]])
        linked = ids[some[:-1][100 * both >= percent * (n[some[:-1]] + n[at] - both)]]
        if len(linked):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(linked), ids[at])), pa.array(linked)], names=["a", "b"])


def _tokens(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, comp, n, token) for each shingle."""
    for whole in batches:
        for batch in slices(whole, "text", 1_500_000):
            sets = shingle_sets(texts(batch.column("text")), k)
            row = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
            kept = [batch.column(c).take(row) for c in ("doc_id", "comp", "n")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate([np.zeros(0, dtype=np.uint64), *sets]).view(np.int64))], names=["doc_id", "comp", "n", "token"])


def meet(ids: np.ndarray, comp: np.ndarray, n: np.ndarray, pos: np.ndarray, side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of documents that share a token at places ``pos`` of their ``n`` ordered tokens and can still be similar enough: of several components, and of both sides if there are two."""
    order = np.argsort(n, kind="stable")
    ids, comp, n, pos, side = (x[order] for x in (ids, comp, n, pos, side))
    left, right = [], []
    # The most tokens that a larger partner may have, from the places that are left behind the shared token.
    most = ((100 + percent) * (n - pos) - percent * n) // percent
    crossed = side.min() != side.max()
    for a in range(0, len(ids), 128):
        x = slice(a, min(a + 128, len(ids)))
        stop = int(np.searchsorted(n, most[x].max(), side="right"))
        if stop <= a:
            continue
        y = slice(a, stop)
        room = (100 + percent) * np.minimum((n - pos)[x, None], (n - pos)[None, y])
        fits = (room >= percent * (n[x, None] + n[None, y])) & (comp[x, None] != comp[None, y])
        fits &= np.arange(a, stop)[None, :] > np.arange(a, x.stop)[:, None]
        if crossed:
            fits &= side[x, None] != side[None, y]
        i, j = np.nonzero(fits)
        left.append(ids[a + i])
        right.append(ids[a + j])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _meet(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for unit in grouped(batches, "unit"):
        a, b = meet(*[unit.column(c).to_numpy() for c in ("doc_id", "comp", "n", "pos", "side")], percent)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _open(members: DataFrame) -> DataFrame:
    """The values of lists with documents of several components."""
    return members.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("value")


def _pairs_by_prefix(rest: DataFrame, bodies: DataFrame, k: int, percent: int, block: int) -> DataFrame:
    """(a, b) of (doc_id, comp): pairs of several components that share one of their rarest shingles in fitting places."""
    tokens = cut(spread(rest.join(bodies, "doc_id").select("doc_id", "comp", "n", "text"), "doc_id").mapInArrow(Lean(_tokens, k), "doc_id long, comp long, n long, token long"), "tokens")
    often = tokens.groupBy("token").agg(F.count("*").alias("often")).filter("often > 1")
    ranked = tokens.join(often, "token").groupBy("doc_id", "comp", "n").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("t"))
    # Tokens of one document only come first in the order of rarity and meet nothing.
    alone = F.col("n") - F.size("t")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    posts = ranked.select("doc_id", "comp", "n", alone.alias("alone"), F.posexplode(F.slice("t", F.lit(1), F.greatest(prefix - alone, F.lit(0)).cast("int"))).alias("i", "x"))
    posts = cut(posts.select(F.col("x.token").alias("token"), "doc_id", "comp", "n", (F.col("alone") + F.col("i")).cast("long").alias("pos")), "prefixes")
    lists = posts.groupBy("token").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    met = posts.join(lists.select("token", F.ceil(F.col("size") / block).cast("int").alias("blocks")), "token")
    met = met.withColumn("side", F.pmod(F.xxhash64("doc_id"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("blocks") - 1).cast("long"))))
    met = met.select("doc_id", "comp", "n", "pos", F.col("side").cast("long").alias("side"), F.xxhash64("token", F.least("side", "other"), F.greatest("side", "other")).alias("unit"))
    return spread(met, "unit").sortWithinPartitions("unit").mapInArrow(Lean(_meet, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked at ``percent`` similarity of their k-word shingle sets.

    Assumes that one doc_id means one text (repeated rows are fine).
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = cut(base.mapInArrow(Lean(_sign, k), "doc_id long, n_shingles long, f1 long, f2 long, coords array<long>"), "minhash")
    live = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = cut(live.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = classes.select(F.col("rep").alias("doc_id"))
    sigs = cut(live.join(reps, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("doc_id", F.col("n_shingles").alias("n"), "coords"), "signatures")
    posted = sigs.select("doc_id", F.explode(F.slice("coords", 1, COORDS - MATCHES + 1)).alias("value"))
    lists = posted.groupBy("value").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("value")
    members = cut(posted.join(lists, "value", "left_semi"), "members")
    bodies = cut(base.join(members.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"]).join(sigs, "doc_id"), "bodies")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        """The links among pairs (a, b): a is compared with ``UNIT`` documents at a time."""
        sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / UNIT).alias("parts"))
        dealt = pairs.join(sizes, "a").select("a", "b", F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("parts"))).alias("unit"))
        rows = dealt.select("unit", F.col("b").alias("doc_id"), F.lit(False).alias("leads")).unionByName(dealt.select("unit", F.col("a").alias("doc_id"), F.lit(True).alias("leads")).distinct())
        work = spread(rows.join(bodies, "doc_id"), "unit").sortWithinPartitions("unit")
        return cut(work.mapInArrow(Lean(_confirm, k, percent), "a long, b long"), name)

    open_ = members.withColumn("comp", F.col("doc_id"))
    links, found = None, None
    for r in range(ROUNDS):
        rank = F.col("doc_id") if r == 0 else F.xxhash64("doc_id", F.lit(r))
        leaders = open_.groupBy("value").agg(F.min(F.struct(rank.alias("rank"), "doc_id", "comp")).alias("x")).select("value", F.col("x.doc_id").alias("a"), F.col("x.comp").alias("with"))
        ties = cut(open_.join(leaders, "value").filter("comp != with").select("a", F.col("doc_id").alias("b")).distinct(), "ties")
        new = confirmed(ties, "links")
        links = new if links is None else links.unionByName(new)
        found = components(links, "links")
        labelled = members.join(found.select(F.col("node").alias("doc_id"), F.col("root").alias("comp")), "doc_id", "left").select("value", "doc_id", F.coalesce("comp", "doc_id").alias("comp"))
        open_ = cut(labelled.join(_open(labelled), "value", "left_semi"), "open")
        rest = open_.select("doc_id", "comp").distinct()
        if new.count() <= WORTH * rest.count():
            break
    if not open_.isEmpty():
        links = links.unionByName(confirmed(cut(_pairs_by_prefix(rest, bodies, k, percent, block), "pairs"), "links"))
        found = components(links, "links")
    least = found.groupBy("root").agg(F.min("node").alias("component"))
    linked = found.join(least, "root").select(F.col("node").alias("rep"), "component")
    named = classes.join(linked, "rep", "left").select("f1", "f2", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "f1", "f2").join(named, ["f1", "f2"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    cid = F.when(F.col("doc_id").isNotNull(), own)
    return out.select("doc_id", "n_shingles", cid.alias("component_id"), F.coalesce(F.col("doc_id") == cid, F.lit(True)).alias("kept"))
