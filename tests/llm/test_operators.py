"""Each operator on a small table with nulls, empty and long texts, ties, repeated rows and clashing columns, against brute force."""

import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quillsift.llm import decontam, html, huffman, langid, media, packing, quality, simhash, suffix, tokens, warc

try:
    import public_tokenizers as P
except ImportError:
    P = None
needs_tokenizers = pytest.mark.skipif(P is None, reason="no tokenizer files")
RNG = random.Random(11)
SYLLABLES = "the of and on er ing ti re ha en st ou ly ble nd".split()


def prose(n):
    return " ".join("".join(RNG.choice(SYLLABLES) for _ in range(RNG.randint(1, 4))) + RNG.choice(["", "", "", ".", ","]) for _ in range(n))


PASSAGE = prose(60)
TEXTS = [prose(80), None, "", "one", "two words", "  \n\t ", prose(30) + " " + PASSAGE + " " + prose(10), PASSAGE + "\n" + prose(20), prose(3000), "Ünïcode ß " * 30, "ab " * 400, PASSAGE, "日本語テキスト" * 20]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(20, TEXTS[0]), (21, TEXTS[0] + " more"), (22, TEXTS[8][:-5]), (22, TEXTS[8][:-5]), (None, TEXTS[6]), (None, None)]
# Names that operators use themselves must not clash.
COLUMNS = "doc_id long, text string, score double, digest string, fp long, __order long, n_tokens long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0.5, "x", 1, 2, 3) for r in ROWS], COLUMNS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def reference(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path(path))
    return lambda x: [*t.encode(x or "", add_special_tokens=False).ids, 2]


@needs_tokenizers
@pytest.mark.parametrize("path", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_like_whole_texts(path):
    odd = ["  two  ", "a\tb\nc\r\nd", "x\x01y", "\x02ab cd", "É ́x", "a.b, c. 'tis it's  don't\n\nnew", " nb sp", "ΑΣ ΣΑ. ΑΣ", "<|endoftext|> x", "w.\n", "\n l", "İstanbul Ünter", "x, ,y . ..", "a\u0085b", "<|startoftext|>one two<|endoftext|>", "[x] <|endoftext|>. A <|ENDOFTEXT|>", "a<|endoftext|><|endoftext|> b <|endoftext|"]
    texts = [t for _, t in ROWS] + odd + ["".join(RNG.choice(" \n\tab.,é'1ÀΣß") for _ in range(RNG.randint(1, 40))) for _ in range(2000)]
    e, want = tokens.PieceEncoder(P.path(path), remembered=500), reference(path)
    for k in range(0, len(texts), 700):
        part = texts[k : k + 700]
        ids, counts = tokens.with_end(*e.encode(pa.array(part, pa.string())), 2)
        lists = [want(t) for t in part]
        assert counts.tolist() == [len(x) for x in lists] and ids.tolist() == [i for x in lists for i in x]


@needs_tokenizers
def test_packing(docs, empty):
    path, want = P.path("word_bpe_49k.json"), reference("word_bpe_49k.json")
    rows = packing.pack(docs, path, capacity=128, piece=32, group=8).collect()
    whole = sorted(zlib.crc32(np.array(want(t), "<u4").tobytes()) for _, t in ROWS)
    by_doc, windows = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 128
    for i, t in ROWS:
        if i not in (None, 22):
            ids, at = np.array(want(t), "<u4"), 0
            for r in sorted(by_doc[i], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
    assert sum(r.length for r in rows) == sum(len(want(t)) for _, t in ROWS) and len(whole) == len(ROWS)
    assert packing.pack(empty, path).count() == 0


def test_differencing_is_balanced():
    lengths = np.array([RNG.randint(1, 100) for _ in range(300)])
    of = packing.difference(lengths, 20)
    sums = np.bincount(of, lengths, 20)
    assert len(of) == 300 and sums.max() - sums.min() <= 12
    of, offsets, windows = packing.pack_group(np.array([10, 10, 10, 10]), 15)
    assert windows == 4 and offsets.tolist() == [0, 0, 0, 0]
    assert packing.pack_group(np.array([7]), 15)[2] == 1


def test_code_lengths_are_optimal():
    import heapq

    for _ in range(20):
        counts = np.array([RNG.randint(0, 1000) for _ in range(RNG.randint(2, 60))])
        if (counts > 0).sum() < 2:
            continue
        lengths = huffman.code_lengths(counts, 18)
        heap = [int(c) for c in counts if c]
        heapq.heapify(heap)
        total = 0
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            total += both
            heapq.heappush(heap, both)
        assert (counts * lengths).sum() == total and sum(2.0 ** -int(n) for n in lengths if n) == 1
        short = huffman.code_lengths(counts, 6)
        assert short.max() <= 6 and sum(2.0 ** -int(n) for n in short if n) <= 1
    assert huffman.code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0]


@needs_tokenizers
def test_token_files(spark, docs, empty):
    path, want = P.path("byte_bpe_50k.json"), reference("byte_bpe_50k.json")
    files, counts = huffman.store(docs, path, file_tokens=3000)
    rows = huffman.read_files(files).collect()
    assert files.count() > 1 and counts.sum() == sum(len(want(t)) for _, t in ROWS)
    crcs = lambda t: zlib.crc32(np.array(want(t), "<u4").tobytes())
    assert sorted(r.ids_crc32 for r in rows) == sorted(crcs(t) for _, t in ROWS)
    rows.sort(key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    files, _ = huffman.store(empty, path)
    assert files.count() == 0 and huffman.read_files(files).count() == 0


@needs_tokenizers
def test_files_by_groups(spark, docs, monkeypatch):
    monkeypatch.setattr(huffman, "GROUP", 2)
    files, counts = huffman.store(docs.unionByName(docs.withColumn("doc_id", F.lit(None).cast("long"))), P.path("byte_bpe_50k.json"), file_tokens=1500)
    rows = sorted(files.collect(), key=lambda r: r.part)
    assert len(rows) > 4 and [r.start for r in rows] == [sum(x.n for x in rows[:k]) for k in range(len(rows))] and sum(r.n for r in rows) == counts.sum()


PAGES = [(1, "http://a/", "<p>" + "x" * 200), (2, "http://b/\r\nEvil: 1", "<p>" + "x" * 200), (3, "http://c/", "short"), (4, "http://d/", "short"), (5, None, None), (6, "http://e/", ""), (None, "http://f/", "<p>" + "x" * 200), (1, "http://a/", "<p>" + "x" * 200), (7, "http://g/", "é" * 100)]


def test_warc(spark):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string").repartition(2)
    index = warc.write(pages)
    rows = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(index).collect()), key=repr)
    want = []
    for i, _, h in PAGES:
        b = (h or "").encode()
        first = min((j for j, _, g in PAGES if j is not None and g == h), default=None) if len(b) >= 100 else i
        refers = first if len(b) >= 100 and (i is None or i > first) else None
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if refers is None else "revisit", refers))
    assert rows == sorted(want, key=repr)
    r = index.filter("page_id = 7").first()
    with open(r.file.removeprefix("file://"), "rb") as f:
        f.seek(r.offset)
        assert gzip.decompress(f.read(r.length)).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert warc.read(index.filter("page_id in (3, 7)")).count() == 2  # selected records alone
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_requests_are_coalesced():
    assert list(warc.requests([(0, 10), (10, 5), (100_000, 7), (100_007, 1)])) == [(0, 2, 0, 15), (2, 4, 100_000, 100_008)]
    assert list(warc.requests([])) == []


def shingle_print(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def joined(fps, ids):
    """Brute-force components over links at 3 bits, named by their smallest id."""
    group = list(range(len(fps)))
    find = lambda x: x if group[x] == x else find(group[x])
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                group[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [least[find(i)] for i in range(len(fps))]


def test_simhash(docs, empty):
    fps = [shingle_print(t) for _, t in ROWS]
    want = sorted(((i, simhash.signed(f), c) for (i, _), f, c in zip(ROWS, fps, joined(fps, [i for i, _ in ROWS]))), key=repr)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in simhash.components(docs).collect()), key=repr) == want
    assert simhash.components(empty).count() == 0


def test_gray_index_by_brute_force():
    base = [RNG.getrandbits(64) for _ in range(30)]
    fps = np.unique(np.array([b ^ sum(1 << RNG.randrange(64) for _ in range(RNG.randint(0, 4))) & (1 << 64) - 1 for b in base for _ in range(20)], np.uint64))
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    found = {(int(i), int(j)) for a, b in simhash.GrayIndex(fps).links(3, queries=64) for i, j in zip(a, b)}
    assert found == {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if int(fps[i] ^ fps[j]).bit_count() <= 3}
    a, b = simhash.group_links(np.zeros(len(fps), np.int64), fps)
    assert joined([int(x) for x in fps], range(len(fps))) == connect(fps, a, b) and len(a) < len(fps)


def connect(fps, a, b):
    group = {int(f): i for i, f in enumerate(fps)}
    changed = True
    while changed:
        changed = False
        for x, y in zip(a.tolist(), b.tolist()):
            low = min(group[x], group[y])
            changed |= group[x] != low or group[y] != low
            group[x] = group[y] = low
    return [group[int(f)] for f in fps]


def test_crowded_groups_are_keyed_again(spark):
    base = RNG.getrandbits(63)
    fps = sorted({base ^ (1 << RNG.randrange(40)) ^ (1 << RNG.randrange(40)) for _ in range(300)} | {RNG.getrandbits(63) for _ in range(50)})
    distinct = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.v: r.root for r in simhash.connected(simhash.links(distinct, large=20)).collect()}
    want = joined(fps, fps)
    assert [roots.get(f, f) for f in fps] == want


def removed(rows):
    """Brute force: bytes covered by strings of 50 that start in a document with a smaller id."""
    key = lambda i: suffix.NEVER if i is None else i
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            s = b[k : k + 50]
            first[s] = min(first.get(s, suffix.NEVER), key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < key(i):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, many", [(1 << 22, 64), (3000, 0), (3000, 10**6)])
def test_suffix(docs, block, many):
    found = suffix.removal(docs, ["doc_id"], block, many).withColumn("h", F.sha2("kept", 256))
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.h) for r in found.collect()), key=repr) == removed(ROWS)


def test_strings_whose_hashes_agree_in_part(spark):
    # Different strings around one anchor, whose hashes agree in the low 40 bits and in the bucket.
    texts = ["fdyhnuoynslvviilvsmqablzfswduxfhhuifusifkdevlqrgqi", "zeytnqvhrslvviilvsmqablzfswduxfhhuifusifkxsoeypevb"]
    h = [int(suffix.string_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0]), np.array([50]))[0]) for t in texts]
    assert h[0] != h[1] and (h[0] ^ h[1]) % (1 << 40) == 0
    rows = [(1, texts[0]), (2, texts[1]), (3, texts[0])]
    found = suffix.removal(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], many=0)
    assert {r.doc_id: r.n_removed for r in found.collect()} == {1: 0, 2: 0, 3: 50}


def test_texts_longer_than_a_step(spark):
    assert suffix.STEP < 300_000
    letters = "".join(RNG.choices("abcdefgh ", k=640_000))
    first, second = letters[:320_000], letters[320_000:]
    mixed = second[:100] + first[200_000:320_000] + second[100:150_000] + first[suffix.STEP - 60 : suffix.STEP + 60] + second[150_000:]
    rows = [(1, first), (2, mixed), (3, second[-70:] + "x" + second[:60])]
    found = suffix.removal(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).withColumn("h", F.sha2("kept", 256))
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.h) for r in found.collect()) == removed(rows)


def test_suffix_keeps_columns(docs, empty):
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns and out.filter("doc_id = 11").count() == 0 and out.filter("doc_id = 2").count() == 1
    assert suffix.removal(empty, ["doc_id"]).count() == 0


def edited(text, n):
    words = text.split()
    for k in RNG.sample(range(len(words)), n):
        words[k] = "changed" + str(k)
    return " ".join(words)


def test_similar(spark, docs, empty):
    texts = [prose(300) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, edited(t, 4)) for i, t in enumerate(texts)] + [(200 + i, edited(t, 60)) for i, t in enumerate(texts)]
    found = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == i for i in range(40)) and all(found[200 + i] == 200 + i for i in range(40))
    assert sum(found[100 + i] == i for i in range(40)) >= 38  # a similarity of about 0.88
    own = {r.doc_id: r.component_id for r in simhash.similar(docs).collect()}
    assert own[20] == 0 and own[21] == 0 and own[22] == 8 and own[3] == 3
    assert simhash.similar(empty).count() == 0


def test_similar_is_verified(spark):
    lines = [prose(8) for _ in range(4)]  # repeated lines of two texts that have little else in common
    rows = [(i, " ".join(lines * 12) + " " + prose(300)) for i in range(6)]
    base = prose(304).split()
    near = [base[:k] + ["other%d" % k] * 3 + base[k + 3 :] for k in range(0, 290, 10)]  # 0.95 of the base, 0.91 of each other
    apart = " ".join(prose(1) if k % 22 == 0 else w for k, w in enumerate(base))  # each change costs 5 of 300 shingles
    sets = [set(simhash.shingle_set(" ".join(base), 5).tolist()), set(simhash.shingle_set(apart, 5).tolist())]
    assert 0.55 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.75
    rows += [(10, " ".join(base)), (11, apart)] + [(20 + i, " ".join(w)) for i, w in enumerate(near)]
    # A chain: each is near the next alone.
    chain = prose(340).split()
    rows += [(100 + i, " ".join(chain[6 * i : 6 * i + 300])) for i in range(6)]
    for i in range(40):  # pairs just above the bound
        w = prose(304).split()
        rows += [(200 + 2 * i, " ".join(w)), (201 + 2 * i, " ".join("zz%d" % k if k in (30, 80, 130, 180, 230, 280) else x for k, x in enumerate(w)))]
    found = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    least = least_similar(rows)
    assert found == least and found[11] == 11 and found[5] == 5 and found[105] == 100 and found[201] == 200


def test_crowded_near_copies(spark):
    base = prose(200).split()
    rows, chain = [], prose(400).split()
    for i in range(120):  # near copies of one page, each with words of its own
        w = list(base)
        for k in RNG.sample(range(200), 1):
            w[k] = f"own{i}x{k}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, " ".join(w if k % 25 else f"far{i}" for k, w in enumerate(base))) for i in range(6)]  # like the page, but under the bound
    rows += [(300 + i, " ".join(chain[4 * i : 4 * i + 220])) for i in range(30)] + [(400 + i, prose(100)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = least_similar(rows)
    for crowded in (1 << 14, 20):
        assert {r.doc_id: r.component_id for r in simhash.similar(docs, crowded=crowded).collect()} == want
    assert want[119] == 0 and want[205] == 205 and want[329] == 300


def least_similar(rows):
    """Brute force: the least id that is reachable over pairs at a similarity of 0.8."""
    sets = {i: set(simhash.shingle_set(t, 5).tolist()) for i, t in rows}
    least = {i: i for i in sets}
    near = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in near:
            if least[i] != least[j]:
                least[i] = least[j] = min(least[i], least[j])
                changed = True
    return least


def test_leaders_leave_no_link_out():
    base = [np.array([RNG.getrandbits(64) for _ in range(4)], np.uint64) for _ in range(12)]
    fps = []
    for _ in range(600):
        x = RNG.choice(base).copy()
        for b in RNG.sample(range(256), RNG.randint(0, 45)):
            x[b // 64] ^= np.uint64(1 << b % 64)
        fps.append(x)
    fps = np.unique(np.stack(fps), axis=0)
    n = len(fps)
    near = [(i, j) for i in range(n) for j in range(i) if int(np.bitwise_count(fps[i] ^ fps[j]).sum()) <= 60]
    ids = np.arange(n).astype(np.uint64)
    a, b = simhash.group_links(np.zeros(n, np.int64), ids, fps, 60, 48, simhash.spanning)
    assert connect(ids, a, b) == connect(ids, *(np.array(x) for x in zip(*near))) and {(max(x, y), min(x, y)) for x, y in zip(a.tolist(), b.tolist())} <= set(near)
    part = np.array([RNG.randrange(5) for _ in range(n)])
    order = np.argsort(part, kind="stable")
    index = simhash.GrayIndex(fps[order], part[order])
    assert {(order[i], order[j]) for x, y in index.links(60) for i, j in zip(x, y)} | {(order[j], order[i]) for x, y in index.links(60) for i, j in zip(x, y)} == {p for i, j in near if part[i] != part[j] for p in ((i, j), (j, i))}


def test_spanning_edges_are_links():
    a = np.array([RNG.randrange(60) for _ in range(90)])
    b = np.array([RNG.randrange(60) for _ in range(90)])
    x, y = simhash.spanning(a, b)
    pairs = {(min(i, j), max(i, j)) for i, j in zip(a.tolist(), b.tolist())}
    values = sorted({*a.tolist(), *b.tolist()})
    assert set(zip(x.tolist(), y.tolist())) <= pairs and connect(values, x, y) == connect(values, a, b)
    assert len(x) == len(values) - len(set(connect(values, a, b)))


def test_without_copies(docs, empty):
    out = simhash.without_copies(docs)
    ids = sorted(r.doc_id for r in out.filter("doc_id is not null").collect())
    assert 0 in ids and 20 not in ids and len(ids) == len(set(ids)) and out.columns == docs.columns
    assert simhash.without_copies(empty).count() == 0


def test_without_copies_by_row(spark):
    a, b, c, d, e = (prose(60) for _ in range(5))
    rows = [(1, a), (None, a), (None, b), (5, c), (7, a), (7, d), (7, d), (8, e), (8, prose(60))]
    out = simhash.without_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=repr) == sorted([(1, a), (None, b), (5, c), (7, d), *rows[7:]], key=repr)


ITEMS = [(1, PASSAGE), (2, prose(40)), (3, None), (4, ""), (5, "short item"), (6, prose(35))]


def test_decontamination(spark, empty):
    noisy = ITEMS[1][1].split()
    noisy[3], noisy[20] = "changed", "too"
    rows = [(1, prose(50) + " " + PASSAGE.upper() + " " + prose(5)), (2, "x " + " ".join(noisy) + " y"), (3, prose(400)), (4, None), (5, ""), (6, "a Short,  item here"), (7, PASSAGE[: len(PASSAGE) // 2]), (None, ITEMS[5][1]), (1, prose(10))]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, edits string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.edits for r in decontam.leaks(docs, items).collect()}
    assert set(found) == {(1, 1), (2, 2), (6, 5), (None, 6)} and found[1, 1] == 0 and 0 < found[2, 2] < 20
    kept = decontam.clean(docs, items)
    assert sorted((r.doc_id for r in kept.collect())) == [1, 3, 4, 5, 7] and kept.columns == docs.columns
    assert decontam.leaks(empty, items).count() == 0 and decontam.leaks(docs, items.limit(0)).count() == 0


def distance(p, t):
    before = [0] * (len(t) + 1)
    for i in range(1, len(p) + 1):
        now = [i]
        for j in range(1, len(t) + 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (p[i - 1] != t[j - 1])))
        before = now
    return min(before)


def test_edit_distance_by_brute_force():
    for _ in range(200):
        p = bytes(RNG.choice(b"abc ") for _ in range(RNG.randint(1, 30)))
        t = bytes(RNG.choice(b"abc ") for _ in range(RNG.randint(0, 40)))
        assert decontam.best_distance(p, t, len(p)) == distance(p, t)


def with_edits(text, n):
    chars = list(text)
    for _ in range(n):
        p, kind, c = RNG.randrange(len(chars)), RNG.randrange(3), RNG.choice("abcdefghijklmnop")
        chars[p : p + (kind != 0)] = [c] if kind < 2 else []
    return "".join(chars)


@pytest.mark.parametrize("low, high", [(32, 40), (40, 50), (50, 60), (60, 80), (80, 120), (120, 240)])
def test_recall_by_length(low, high):
    items = []
    while len(items) < 60:
        text = " ".join(re.sub("[.,]", "", prose(60)).split())[: RNG.randrange(low, high)].strip()
        items += [text] if len(text) >= low else []
    index = decontam.Index(list(range(60)), items, 0.85)
    for share, least in ((0, 1.0), (0.05, 0.99), (0.1, 0.97), (0.15, 0.9)):
        texts = [prose(20) + " " + with_edits(t, int(share * len(t))) + " " + prose(20) for t in items]
        # Brute force: every item against every text.
        plain = [decontam.folded(pa.array([t]))[0].tobytes() for t in texts]
        near = {(r, k): d for r in range(60) for k in ([r] if share else range(60)) if (d := decontam.best_distance(items[k].encode(), plain[r], 999)) <= index.most[k]}
        found = {(r, k): d for r, k, d in index.matches(pa.array(texts))}
        assert len(set(near) & set(found)) >= least * len(near)
        assert all(near[x] == found[x] for x in set(near) & set(found)) and (share or set(found) == set(near))


def test_texts_that_repeat_themselves():
    items = ["x" * 100, "ab " * 40, "the same words again " * 6]
    index = decontam.Index([0, 1, 2], items, 0.85)
    texts = ["x" * 200_000, "ab " * 50_000, "the same words again " * 10_000, "y" * 100_000, prose(100)]
    assert {(r, k) for r, k, _ in index.matches(pa.array(texts))} == {(0, 0), (1, 1), (2, 2)}


def test_items_with_few_windows():
    items = [re.sub("[.,]", "", x)[:n].strip() for n in (32, 34, 36, 40, 48) for x in ("counterrevolutionaries assembled quietly", prose(40), prose(40))]
    items = [x for x in items if len(x) >= decontam.SHORT] + ["日本語の文章には空白がありませんので単語で始まらない", "漢字仮名交じり文" * 9, "ภาษาไทยเขียนติดกันโดยไม่เว้นวรรค", "x" * 20 + "y" * 20]
    index = decontam.Index(list(range(len(items))), items, 0.85)
    texts = [prose(20) + " " + x + " " + prose(20) for x in items] + ["前の文" + x + "後の文" for x in items] + [prose(200), "日本語テキスト" * 50]
    found = {(r, k) for r, k, d in index.matches(pa.array(texts)) if d == 0}
    assert {(r, r % len(items)) for r in range(2 * len(items))} <= found
    assert not any(r >= 2 * len(items) for r, _ in found)
    long = "漢字仮名交じり文は空白なしで書かれ、単語の境目が見えない。それでも一部が変わった項目を見つける必要がある"
    assert decontam.Index([1], [long], 0.85).matches(pa.array(["前置き" + long.replace("境目", "境界") + "後書き"]))


def test_media(docs, empty):
    rows = media.store(docs)
    places = media.catalogue(rows)
    got = {r.digest: r for r in media.features(places).join(media.metadata(places), "digest").collect()}
    assert len(got) == len({(t or "") for _, t in ROWS})
    want = []
    for i, t in ROWS:
        b = (t or "").encode()
        p = media.payload_of(b)
        assert len(p) % 576 == 0 and p.rstrip(b"\xff") == b and len(p) > 0
        r = got[hashlib.sha256(p).hexdigest()]
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32, r.width * r.height) == (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(p))
        assert r.media_sha256 == hashlib.sha256(media.png(p)).hexdigest() and media.png_payload(media.png(p)) == p
        want.append((i, len(b)))
    assert sorted(((r.doc_id, r.n_bytes) for r in rows.collect()), key=repr) == sorted(want, key=repr)
    assert media.features(media.catalogue(media.store(empty))).count() == 0


LANGUAGES = {"aa": "tra la lo mi fa".split(), "bb": "zuk grom vor katt stein".split()}


def test_language(spark):
    say = lambda l, n: " ".join("".join(RNG.choice(LANGUAGES[l]) for _ in range(RNG.randint(1, 3))) for _ in range(n))
    rows = [(i, say(l, RNG.randint(5, 40)), l) for i, l in enumerate(["aa", "bb"] * 60)] + [(None, say("aa", 9), "bb"), (500, None, "aa"), (501, "123 !?", "aa"), (502, "", None), (503, "日本", None), (504, say("bb", 2000), None), (504, say("bb", 3), None)]
    docs = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, lang string, score double, lang_pred string")
    model = langid.learn(docs, F.col("doc_id") % 2 < 2)
    got = {(r.doc_id, r.lang_pred) for r in langid.predicted(docs.drop("score", "lang_pred"), model, "doc_id").collect()}
    assert {(500, "und"), (501, "und"), (502, "und"), (504, "bb")} <= got and ((503, "aa") in got or (503, "bb") in got)
    assert sum((i, l) in got for i, _, l in rows[:120]) >= 118
    nothing = langid.learn(docs.filter("lang is null"), F.lit(True))
    assert {r.lang_pred for r in langid.predicted(docs.select("doc_id", "text"), nothing, "doc_id").collect()} == {"und"}
    assert langid.predicted(docs.select("doc_id", "text").limit(0), model, "doc_id").count() == 0
    # A word not seen is scored by its longest n-grams that are.
    assert model.predict(pa.array(["traxx", "grommm"]))[0] == ["aa", "bb"]


def naive_backoff(rows, text, languages, words=10**6, most=10**6):
    """Scores of a text, word by word in dictionaries."""
    from collections import Counter

    counts = {l: Counter(w for t, x in rows if x == l for w in langid.WORD.findall((t or "").lower())) for l in languages}
    parts = {l: Counter() for l in languages}
    for l in languages:
        for w, n in counts[l].items():
            for o in langid.ORDERS:
                for g in langid.grams(w, o):
                    parts[l][o, g] += n

    def logs(c, k):
        every = {e for x in c.values() for e in x}
        return np.array([np.log((c[l][k] + 0.5) / (sum(c[l].values()) + 0.5 * len(every))) for l in languages])

    total, found = np.zeros(len(languages)), langid.WORD.findall(text.lower())
    for w in found:
        if any(w in c for c in counts.values()):
            total += logs(counts, w)
            continue
        for o in langid.ORDERS:
            known = [(o, g) for g in langid.grams(w, o) if any((o, g) in c for c in parts.values())]
            if known:
                total += np.mean([logs(parts, g) for g in known], axis=0)
                break
    mean = total / max(1, len(found)) * min(12, len(found))
    return total, np.exp(mean[total.argmax()]) / np.exp(mean).sum()


def test_language_by_brute_force(spark):
    texts = ["tra la lo mi", "la la fa", "zuk gromvor katt", "stein vor zuk é", "lo\u0301fa mi"]
    rows = list(zip(texts, ["aa", "aa", "bb", "bb", "aa"]))
    docs = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(rows)], "doc_id long, text string, lang string")
    model = langid.learn(docs, F.lit(True))
    asked = ["tra zuk", "tralo grom", "xyz", "a b c tr", "\u0301tra \u0301\u0301 zuk\u0301x", "LA Stein,vor-fa", "1 tra2la 3", "日本 la", "é É", "f", "ŉzuk ÀLA", "la" * 30 + " zuk"]
    langs, scores = model.predict(pa.array(asked))
    for t, l, s in zip(asked, langs, scores):
        total, share = naive_backoff(rows, t, ["aa", "bb"])
        assert abs(s - share) < 1e-5 and (abs(total[0] - total[1]) < 1e-5 or l == ["aa", "bb"][total.argmax()]), t


def test_long_texts_are_added_up(spark, monkeypatch):
    texts = [None, "tra la " * 50, "", "zuk grom " * 3000 + "tra", "é" * 999 + " la", "x"]
    docs = spark.createDataFrame([(0, "tra la lo", "aa"), (1, "zuk grom", "bb")], "doc_id long, text string, lang string")
    model = langid.learn(docs, F.lit(True))
    whole = model.predict(pa.array(texts))
    monkeypatch.setattr(langid.parts, "__defaults__", (100,))
    cut = model.predict(pa.array(texts))
    assert whole[0] == cut[0] and np.allclose(whole[1][:4], cut[1][:4]) and whole[0][3] == "bb"


def test_words_like_the_pattern():
    texts = ["a b", "\u0301a\u0301 ", "", "x1y", "\u0301", "日本語 テ", "z"]
    joined = "".join(texts)
    begins = np.cumsum([0] + [len(t) for t in texts])[:-1]
    starts, lengths = langid.words_of(np.frombuffer(joined.encode("utf-32-le"), "<u4"), begins)
    assert [joined[a : a + n] for a, n in zip(starts, lengths)] == [w for t in texts for w in langid.WORD.findall(t)]


def test_quality(spark, docs):
    good = [(i, prose(RNG.randint(10, 120)), 1) for i in range(400)]
    junk = [(400 + i, " ".join(w + "###" for w in prose(40).split()), None) for i in range(60)]
    rows = good + junk + [(900, None, None), (901, "", None), (None, prose(30), 1), (0, good[0][1], 1)]
    table = spark.createDataFrame([(i, t, 0.1) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if q is not None], "doc_id long, quality int")
    model = quality.learn(table.select("doc_id", "text"), labels)
    assert 0.7 < model.prior <= 0.98
    got = {r.doc_id: r.score for r in quality.scored(table.drop("score"), model, "doc_id").collect()}
    assert np.mean([got[i] >= 0.3 for i in range(400)]) > 0.97 and np.mean([got[400 + i] < 0.3 for i in range(60)]) > 0.9
    assert all(0 <= s <= 1 for s in got.values()) and {900, 901, None} <= set(got)
    assert {r.score for r in quality.scored(table.drop("score"), quality.learn(table, labels.limit(0)), "doc_id").collect()} == {0.5}
    assert quality.scored(table.limit(0).drop("score"), model, "doc_id").count() == 0


def test_class_prior():
    rng = np.random.default_rng(1)
    p = rng.normal(2, 1, 20_000)
    u = np.concatenate((rng.normal(2, 1, 14_000), rng.normal(-2, 1, 6_000)))
    steps = quality.upper_sets(p)
    assert abs(quality.class_prior(p, steps, np.array([np.mean(u >= t) for t in steps]), len(u)) - 0.7) < 0.03


def test_shares_are_counted_over_all_rows(spark):
    rows = [(i, prose(RNG.randint(1, 30)) if i % 9 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    x = quality.features(pa.array([t for _, t in rows]))
    rng = np.random.default_rng(2)
    models = [quality.Model(x.mean(0), x.std(0) + 1e-3, [rng.normal(0, 1, (x.shape[1], 4)), np.zeros(4), rng.normal(0, 1, 4), np.zeros(1)], 0.5) for _ in range(2)]
    marked = {r.doc_id for r in docs.filter(quality.half()).collect()}
    own = np.array([i in marked for i, _ in rows])
    z = [quality.forward(m.weights, m.scaled(x[own == k]))[0] for m, k in zip(models, (True, False))]
    steps = [np.quantile(a, [0.05, 0.31, 0.777][: 3 - k]) + 1e-4 for k, a in enumerate(z)]
    want = [[*(int((a >= t).sum()) for t in s), len(a)] for a, s in zip(z, steps)]
    assert [n.tolist() for n in quality.counts_above(docs, models, steps)] == want and sum(w[-1] for w in want) == 300
    assert [n.tolist() for n in quality.counts_above(docs.limit(0), models, steps)] == [[0] * 4, [0] * 3]


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<title>t</title><p>a<p>b<div>c</div>d", "a\n\nb\n\nc\nd"),
        ("x<script>if (a < b) {}</script><style>p{}</style>y<!-- <p> -->z", "xyz"),
        ("<p hidden>no<p style='display:none'>no<p>yes", "yes"),
        ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes</b></div>", "yes"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "* a\n* b\n  * c"),
        ("<ol start=3><li>a<li>b</ol>", "3. a\n4. b"),
        ("<ol type=i><li>a<li>b</ol>", "i. a\nii. b"),
        ("<table><tr><th>A<th>Bee<tr><td>aaaa<td>b</table>", "A     Bee\naaaa  b"),
        ("<table><tr><td rowspan=2>x<td>1<tr><td>2</table>", "x  1\n   2"),
        ("<pre>\n a\n  b</pre>", " a\n  b"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("1 < 2 <b>bold", "1 < 2 bold"),
        ("<p>x</p><unclosed attr='", "x"),
        ("<details><summary>s</summary>no</details><details open>yes</details>", "s\nyes"),
        ("<!--never closed <p>x", ""),
        ("a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b", "a x=2 b"),
        ("a<svg><title>t</title><path d=''/><g>no<text>one</text><text>two <tspan>three</tspan></text></g></svg>b", "a one two three b"),
        ("<div style='visibility:hidden'><svg><text>no</text></svg></div>", ""),
        ("<map name=m><area href=x><a href=y>yes</a></map>", "yes"),
        ("<table><tr><td>" + "x" * 300 + "<td>b<tr><td>c<td>d</table>", "x" * 300 + "  b\nc  d"),
        ("<table><tr><td>a<td>" + "x" * 300 + "<td>b<tr><td>cc<td>d<td>e</table>", "a   " + "x" * 300 + "  b\ncc  d  e"),
    ],
)
def test_html(page, text):
    assert html.visible_text(page) == text


def test_html_of_any_depth(spark):
    pages = spark.createDataFrame([(1, "<div>" * 20_000 + "deep", 1), (2, None, 1), (2, "<table><tr><td>" * 500 + "x", 1), (None, "", 1)], "page_id long, html string, text long")
    assert sorted(((r.page_id, r.text) for r in html.extracted(pages).collect()), key=repr) == sorted([(1, "deep"), (2, ""), (2, "x"), (None, "")], key=repr)
    assert html.extracted(pages.limit(0)).count() == 0
