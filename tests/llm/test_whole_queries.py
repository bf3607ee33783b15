"""The queries of this subpackage and the stages of the pipeline on the smallest tables, against brute force."""

import hashlib
import pathlib
import zlib

import numpy as np
import pytest
from test_operators import P, joined, least_similar, needs_tokenizers, reference, removed, shingle_print

from quillsift.llm import common, decontam, media, queries, quality, warc

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def benchmark(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def crc(x):
    return zlib.crc32(str(x).encode())


def test_op1(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    want, first = [], {}
    for r in sorted(pages, key=lambda r: r.page_id):
        b = (r.html or "").encode()
        one = first.setdefault(b, r.page_id) if len(b) >= 100 else r.page_id
        want.append((r.page_id, len(b), hashlib.sha256(b).hexdigest(), "response" if one == r.page_id else "revisit", None if one == r.page_id else one))
    got = queries.op1_warc(spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert warc.parse(warc.record(1, "http://a/", b"x", "d", None))[1] == b"x"


def test_op2(spark, docs):
    got = {r.doc_id: r for r in queries.op2_quality(spark, SF).collect()}
    assert set(got) == {i for i, _ in docs} and all(r.held_out == (crc(i) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(got[i].predicted, q) for i, q in known.items() if i in got and got[i].held_out]
    assert np.mean([p == q for p, q in held]) >= 0.75  # learned from some hundred texts


@needs_tokenizers
def test_op3_and_op6(spark, docs):
    want = reference("word_bpe_49k.json")
    pieces, windows = {}, {}
    for r in queries.op3_packing(spark, SF).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in windows.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 4096
    tokens = 0
    for i, t in docs:
        ids, at = np.array(want(t), "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
        tokens += at
    assert len(windows) <= 1.02 * tokens / 4096 + 1  # little padding
    want, at = reference("byte_bpe_50k.json"), 0
    got = {r.doc_id: r for r in queries.op6_tokens(spark, SF).collect()}
    for i, t in sorted(docs):
        ids = np.array(want(t), "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_op4(spark, docs):
    fps = [shingle_print(t) for _, t in docs]
    least = joined(fps, [i for i, _ in docs])
    assert sorted(map(tuple, queries.op4_simhash(spark, SF).collect())) == sorted((i, f"{f:016x}", c) for (i, _), f, c in zip(docs, fps, least))


def leaking(docs, benchmark, short=4000):
    """Brute force: items in documents as they are and, for texts that are not long, within their edits."""
    import pyarrow as pa

    out = {}
    items = [(k, decontam.folded(pa.array([t]))[0].tobytes().strip(b" \0")) for k, t in benchmark]
    for i, t in docs:
        plain = decontam.folded(pa.array([t or ""], pa.string()))[0].tobytes()
        for k, x in items:
            most = int(0.15 * len(x) + 1e-9)
            if x and x in plain:
                out[i, k] = 0
            elif x and len(plain) <= short and not {x[p : p + 6] for p in range(0, len(x) - 5)}.isdisjoint({plain[p : p + 6] for p in range(len(plain) - 5)}) and (d := decontam.best_distance(x, plain, most)) <= most:
                out[i, k] = d
    return out


def test_op5(spark, docs, benchmark):
    short = {i for i, t in docs if len(t or "") <= 800}
    want = leaking(docs, benchmark, 800)
    got = {(r.doc_id, r.item_id): r.edits for r in queries.op5_decontam(spark, SF).collect()}
    assert want and {x: d for x, d in got.items() if d == 0 or x[0] in short} == want


def test_op7(spark, docs):
    got = {r.doc_id: r for r in queries.op7_media(spark, SF).collect()}
    for i, t in docs:
        p = media.payload_of((t or "").encode())
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert r.media_sha256 == hashlib.sha256(media.png(p)).hexdigest() and r.feature == media.feature(p)
    assert len(got) == len(docs)


def test_op8(spark, docs):
    got = {r.doc_id: r for r in queries.op8_langid(spark, SF).collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert set(got) == set(lang) and all(r.held_out == (crc(i) % 3 == 1) for i, r in got.items())
    held = [got[i].lang_pred == l for i, l in lang.items() if got[i].held_out and l is not None and got[i].lang_pred != "und"]
    assert np.mean(held) >= 0.95


def test_op9(spark, docs):
    assert sorted(map(tuple, queries.op9_suffix(spark, SF).collect()), key=repr) == removed(docs)


def test_op10(spark):
    got = queries.op10_html(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/pages.parquet").count() and got.filter("n_chars <> length(text)").count() == 0


@needs_tokenizers
def test_pipeline(spark, docs, benchmark):
    pipeline = pytest.importorskip("corpus_pipeline")
    now, tables = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = now.columns
    for name, stage in pipeline.STAGES:
        now = common.saved(stage(spark, now, SF), f"test-{name}")
        tables[name] = [(r.doc_id, r.text) for r in now.select("doc_id", "text").collect()] if name != "packing" else None
        assert name == "packing" or now.columns == columns
    last = now.collect()
    all_docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = {r.doc_id: r.s for r in quality.scored(all_docs, quality.learn(all_docs, spark.read.parquet(f"{SF}/labels.parquet")), "doc_id", score="s").collect()}
    assert sorted(tables["quality"]) == sorted((i, t) for i, t in docs if scores[i] >= 0.3)
    least = least_similar(tables["quality"])
    assert sorted(tables["near_duplicates"]) == sorted((i, t) for i, t in tables["quality"] if least[i] == i)
    gone = {r[0]: r for r in removed(tables["near_duplicates"])}
    kept = dict(tables["repeated_passages"])
    for i, t in tables["near_duplicates"]:
        if gone[i][2] == 0:
            assert kept[i] == t
        elif i in kept:
            assert len(t.encode()) - gone[i][2] - 4 * gone[i][3] <= len(kept[i].encode()) <= len(t.encode()) - gone[i][2]
    leaks = {i for (i, _), d in leaking(tables["repeated_passages"], benchmark, 800).items()}
    short = {i for i, t in tables["repeated_passages"] if len(t) <= 800}
    rest = {i for i, _ in tables["benchmark_passages"]}
    assert not leaks & rest and {i for i in short if i not in leaks} <= rest
    want = reference("word_bpe_49k.json")
    pieces = {}
    for r in last:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert set(pieces) == rest
    for i, t in tables["benchmark_passages"]:
        ids = np.array(want(t), "<u4")
        assert all(c == zlib.crc32(ids[a : a + n].tobytes()) for a, n, c in pieces[i]) and sum(n for _, n, _ in pieces[i]) == len(ids)
    run = pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, run)) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in last)


@needs_tokenizers
def test_pipeline_with_odd_rows(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(None, None, "en", "s", 0), (None, "", "en", "s", 0), (1, None, None, None, None), (1, "", "en", "s", 0), (2, "one", "de", "s", 3), (2, "one", "de", "s", 3), (None, "some words of a text that is here " * 9, "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, table in (("rows", rows), ("none", [])):
        spark.createDataFrame(table, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(2, 1, None), (None, None, None), (1, None, 0)], "doc_id long, quality int, toxic int").limit(3 if table else 0).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame([(1, None), (2, ""), (None, "words of a text that is here")], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        assert (pipeline.run(spark, f"{tmp_path}/{name}").count() > 0) == bool(table)
