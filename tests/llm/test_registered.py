"""The registered queries that SQL can't express, over their whole tables, against plain computations; the pipeline's stages on awkward tables."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from roadloom.llm.queries import QUERIES, tokenizer_path
from tests.llm.data import documents, frame

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def packed(rows, want):
    """Pieces cover each document's ids; sequences are gapless and at most 2048 long."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == want.keys()
    for d, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        ids = want[d]
        assert [(r.piece, r.start, r.length) for r in pieces] == [(k, k * 2048, len(ids[k * 2048 : (k + 1) * 2048])) for k in range(-(-len(ids) // 2048))]
        assert [r.ids_crc32 for r in pieces] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces]
    for places in by_sequence.values():
        places.sort()
        assert [a for a, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))] and sum(n for _, n in places) <= 2048


def ids_of(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return {d: np.array([*t.encode(x, add_special_tokens=False).ids, 0], dtype="<u4") for d, x in texts.items()}


def test_packing(spark, texts):
    rows = QUERIES["op3_best_fit_packing"](spark, SF).collect()
    packed(rows, ids_of(texts))
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 2048) + 1


def test_decontamination(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op5_decontaminate"](spark, SF).collect()}
    whole = {(d, i) for d, t in texts.items() for i, x in items.items() if x and x in t}
    assert whole <= got and len(got) < len(texts)


def test_toxicity(spark, texts):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op6_toxicity"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    known = [r for r in rows if r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in known]) >= 0.85


def test_repeats(spark, texts):
    seen = defaultdict(int)
    raw = {d: t.encode() for d, t in texts.items()}
    for b in raw.values():
        for i in range(len(b) - 199):
            seen[hash(b[i : i + 200])] += 1
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op8_repeat_removal"](spark, SF).collect()}
    for d, b in raw.items():
        gone = np.zeros(len(b) + 1, dtype=np.int64)
        for i in range(len(b) - 199):
            if seen[hash(b[i : i + 200])] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        cut = np.cumsum(gone)[: len(b)] > 0
        spans = int(cut[:1].sum() + (cut[1:] & ~cut[:-1]).sum())
        kept = np.frombuffer(b, dtype=np.uint8)[~cut].tobytes()
        assert got[d] == (len(b), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_neighbours(spark):
    e = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding is not None}
    e = {i: v for i, v in e.items() if len(v) and np.isfinite(v).all() and v.any()}
    got = defaultdict(list)
    for r in QUERIES["op9_multi_index"](spark, SF).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = total = 0
    for q in (i for i in e if i % 100 == 0):
        d = sorted((float(np.sqrt(((v - e[q]) ** 2).sum())), i) for i, v in e.items() if i != q and len(v) == len(e[q]))[:10]
        assert all(abs(s - float(np.sqrt(((e[i] - e[q]) ** 2).sum()))) < 1e-12 for i, s in got[q]) and got[q] == sorted(got[q], key=lambda x: (x[1], x[0]))
        hits += len({i for _, i in d} & {i for i, _ in got[q]})
        total += len(d)
    assert hits >= 0.9 * total


def test_stages_on_awkward_tables(spark):
    """Nulls, empty and very long texts, copies, repeated rows and clashing columns through all stages."""
    rows = documents(2)
    docs = frame(spark, [*rows, (None, "a row without id")])
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, SF), name)
        assert docs.columns == columns
    kept = docs.collect()
    ids = [r.doc_id for r in kept]
    assert len(ids) == len(set(ids)) and {3000, 3001, 3002, 3007, 3008, None} <= set(ids)
    assert sum(1 for i in ids if i and 2000 <= i < 2030) == 1 and 2000 in ids
    assert {r.score for r in kept} == {"clash"}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    packed(out, ids_of({r.doc_id: r.text or "" for r in kept}))


def test_stages_on_an_empty_table(spark):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, SF), name)
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect() == []
