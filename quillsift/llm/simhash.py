"""SimHash fingerprints, and their links by a Gray-order hierarchical index.

Two fingerprints that differ in at most 3 bits agree in at least 2 of 5 blocks of bits. So each distinct
fingerprint is sent under each of the 10 pairs of blocks, with the bits of that pair as key. The groups of
a key are sorted by Gray rank and indexed: a node of the index holds the bit pattern that all below it
share, an upper node the pattern shared by its children, a child only what its parent has not. Groups meet
from the top; the differences found on the way down add up, and a pair of groups with over 3 is left.

Groups are never unbounded: one with over `large` fingerprints is keyed once more, by the 20 triples of 6
blocks of its other bits, of which 3 must agree too; after that at most 2**20 fingerprints share a key.
Links leave a task as the edges of a spanning forest, so a group of copies costs as many edges as texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Notes, arrow_batches, lean, located, noted, ranges, saved, shuffle_partitions, temporary

DISTANCE = 3
#: Shingles that are counted at once; 255 is the most that a byte counts.
COUNTED = 255 * 128


def shingle_digests(text: str | None, words: int, digest) -> bytes:
    """The digests of a text's shingles in a row: lower case, words joined by blanks; fewer words are one shingle."""
    w = (text or "").encode().lower().split()
    if not w:
        return b""
    joined = b" ".join(w)
    if len(w) <= words:
        return digest(joined)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = np.concatenate(([0], ends[:-words])).tolist()
    return b"".join([digest(joined[a:b]) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())])


def majority(digests: bytes, size: int) -> bytes:
    """The bits that are set in over half of the digests of that many bytes; none: zero."""
    n, counts = len(digests) // size, np.zeros(8 * size, np.int64)
    for at in range(0, n, COUNTED):
        bits = np.unpackbits(np.frombuffer(digests, np.uint8, size * min(COUNTED, n - at), size * at)).view(np.uint64).reshape(-1, size)
        counts += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0).view(np.uint8).reshape(-1, 8 * size).sum(0, dtype=np.int64)
    return np.packbits(2 * counts > n).tobytes()


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The fingerprint of a text; no words: 0."""
    return int.from_bytes(majority(shingle_digests(text, words, lambda x: xxhash.xxh64_digest(x, seed)), 8), "big")


def wide_fingerprint(text: str | None, words: int, seed: int = 42) -> tuple[int, bytes]:
    """A hash of a text's distinct shingles, and a fingerprint of WIDE bits that counts each of them once."""
    digests = shingle_digests(text, words, lambda x: xxhash.xxh3_128_digest(x, seed) + xxhash.xxh3_128_digest(x, seed + 1))
    rows = np.frombuffer(digests, "<u8").reshape(-1, len(WORDS))
    distinct = rows[np.unique(rows[:, 0], return_index=True)[1]].tobytes()
    return xxhash.xxh64_intdigest(distinct), majority(distinct, WIDE // 8)


def shingle_set(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """64-bit hashes of a text's distinct shingles, ascending."""
    return np.unique(np.frombuffer(shingle_digests(text, words, lambda x: xxhash.xxh3_64_digest(x, seed)), "<u8"))


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit integer."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words, seed) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(lean(each), "doc_id bigint, fp bigint")


def masks(bits: list[int], blocks: int, agree: int) -> list[int]:
    """Masks of the bits of each choice of `agree` blocks, of `blocks` even blocks of these bits."""
    cut = [bits[len(bits) * i // blocks : len(bits) * (i + 1) // blocks] for i in range(blocks)]
    return [sum(1 << b for i in chosen for b in cut[i]) for chosen in combinations(range(blocks), agree)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: The first keys: 2 of 5 blocks. For groups that are large, 3 of 6 blocks of the bits outside the first key.
FIRST = masks(list(range(64)), 5, 2)
SECOND = [[m | n for n in masks([b for b in range(64) if not m >> b & 1], 6, 3)] for m in FIRST]


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """The rank of each fingerprint in the Gray order, where neighbours differ in one bit."""
    out = fps.copy()
    for by in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(by)
    return out


class GrayIndex:
    """A hierarchical index of fingerprints (rows of 64-bit words) in Gray order. `ones` holds the shared bits of a node, `own` which of them its parent lacks.

    With parts, `part` holds the part that all rows of a node are of, or MIXED: what is of the query's own part is left with the node.
    """

    FAN, MIXED = 8, np.iinfo(np.int64).min

    def __init__(self, fps: np.ndarray, part: np.ndarray | None = None):
        fps = fps.reshape(len(fps), -1)
        ones, known, parts = [fps], [np.full(fps.shape, ~np.uint64(0))], [part]
        while len(ones[-1]) > self.FAN:
            first = np.arange(0, len(ones[-1]), self.FAN)
            all_one = np.bitwise_and.reduceat(ones[-1] & known[-1], first, axis=0)
            all_zero = np.bitwise_and.reduceat(~ones[-1] & known[-1], first, axis=0)
            ones.append(all_one)
            known.append(all_one | all_zero)
            if part is not None:
                low, high = np.minimum.reduceat(parts[-1], first), np.maximum.reduceat(parts[-1], first)
                parts.append(np.where(low == high, low, self.MIXED))
        self.ones, self.part = ones, parts
        self.own = [k & ~np.repeat(up, self.FAN, axis=0)[: len(k)] for k, up in zip(known, known[1:])] + [known[-1]]

    def near(self, fps: np.ndarray, distance: int, part: np.ndarray | None = None, after: np.ndarray | None = None, queries: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, row) at no more than this distance, of different parts, the row after the given one: groups are left as soon as their differences exceed it."""
        top = len(self.ones) - 1
        queries = max(16, min(queries, (1 << 21) // len(self.ones[0])))
        for at in range(0, len(fps), queries):
            q = np.arange(at, min(at + queries, len(fps)))
            node = np.tile(np.arange(len(self.ones[top])), len(q))
            q = np.repeat(q, len(self.ones[top]))
            differ = np.zeros(len(q), np.uint16)
            for level in range(top, -1, -1):
                if part is not None:
                    other = np.flatnonzero(self.part[level][node] != part[q])
                    q, node, differ = q[other], node[other], differ[other]
                differ = differ + differing(fps[q] ^ self.ones[level][node], self.own[level][node])
                keep = differ <= distance
                if after is not None:
                    keep &= (node + 1) * self.FAN**level > after[q] + 1
                keep = np.flatnonzero(keep)
                q, node, differ = q[keep], node[keep], differ[keep]
                if level:
                    n = len(self.ones[level - 1])
                    q, differ = np.repeat(q, self.FAN), np.repeat(differ, self.FAN)
                    node = (node[:, None] * self.FAN + np.arange(self.FAN)).ravel()
                    inside = np.flatnonzero(node < n)
                    q, node, differ = q[inside], node[inside], differ[inside]
            yield q, node

    def links(self, distance: int, queries: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), i < j, of its own rows."""
        yield from self.near(self.ones[0], distance, self.part[0], np.arange(len(self.ones[0])), queries)


def led(fps: np.ndarray, distance: int, sure=None) -> np.ndarray:
    """A leader's number for each row, within the distance, or its own: each leader takes what no one before it took. So many leaders as make the work a small share of all pairs. sure(leader, rows) decides what is near."""
    out, left = np.arange(len(fps)), np.arange(len(fps))
    for _ in range(min(64, len(fps) // 64 + 1)):
        near = differing(fps[left] ^ fps[left[0]]) <= distance
        if sure is not None:
            near[near] = sure(np.full(np.count_nonzero(near), left[0]), left[near])
        out[left[near]] = left[0]
        left = left[~near]
        if not len(left):
            break
    return out


def differing(x: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    """How many bits of each row are set, within a mask."""
    return np.bitwise_count(x if mask is None else x & mask).sum(1, dtype=np.uint16)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links (a, b): along each component, each value to the next, so that no value has many."""
    values, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    by = np.argsort(label, kind="stable")
    same = np.flatnonzero(label[by][1:] == label[by][:-1])
    return values[by[same]], values[by[same + 1]]


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the links (a, b) that make a spanning forest, the least first, by Boruvka's rounds: unlike in forest(), each edge is a link."""
    a, b = np.minimum(a, b), np.maximum(a, b)
    by = np.lexsort((b, a))
    a, b = a[by], b[by]
    values, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label, taken = np.arange(len(values)), np.zeros(len(a), bool)
    while len(cross := np.flatnonzero(label[x] != label[y])):
        best = np.full(len(values), len(a))
        np.minimum.at(best, label[x[cross]], cross)
        np.minimum.at(best, label[y[cross]], cross)
        chosen = np.unique(best[best < len(a)])
        taken[chosen] = True
        while np.any((u := label[x[chosen]]) != (v := label[y[chosen]])):
            to = np.arange(len(values))
            np.minimum.at(to, np.maximum(u, v), np.minimum(u, v))
            while not np.array_equal(to, to[to]):
                to = to[to]
            label = to[label]
    return a[taken], b[taken]


def group_links(group: np.ndarray, ids: np.ndarray, fps: np.ndarray | None = None, distance: int = DISTANCE, small: int = 12, pick=forest) -> tuple[np.ndarray, np.ndarray]:
    """What pick() makes, by id, of the links between fingerprints of the same group. Without fps the ids are the fingerprints.

    A group of at most `small` is a leaf of the index, whose rows are compared one by one. In a larger one
    leaders take the rows near them first, and the index is asked for links between what they took: a group
    of near copies costs as much as it has rows.
    """
    fps = (ids if fps is None else fps).reshape(len(ids), -1)
    by = np.lexsort((gray_rank(fps[:, 0]), group))
    group, ids, fps = group[by], ids[by], fps[by]
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(group)])))
    left = np.repeat(sizes, sizes) - ranges(np.zeros(len(sizes), np.int64), sizes)  # rows of the group from this one on
    few = np.flatnonzero((np.repeat(sizes, sizes) <= small) & (left > 1))
    found = [(ids[:0], ids[:0])]
    for step in range(1, small):
        few = few[left[few] > step]
        near = few[differing(fps[few] ^ fps[few + step]) <= distance]
        found.append((ids[near], ids[near + step]))
    for k in np.flatnonzero(sizes > small):
        own, name = fps[starts[k] : starts[k] + sizes[k]], ids[starts[k] : starts[k] + sizes[k]]
        label = led(own, distance)
        taken = np.flatnonzero(label != np.arange(len(label)))
        found.append((name[label[taken]], name[taken]))
        order = np.argsort(label, kind="stable")
        own, name, label = own[order], name[order], label[order]
        if label[0] != label[-1]:
            for i, j in GrayIndex(own, label).links(distance):
                found.append(pick(name[i], name[j]))
    return pick(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))


def routed(distinct: DataFrame, large: int) -> DataFrame:
    """Each fingerprint under each of its keys: route (the number of the mask), key (its bits there) and fp."""
    keyed = lambda routes: F.explode(F.array(*[F.struct(F.lit(r).alias("route"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for r, m in routes]))
    first = distinct.select("fp", keyed(enumerate(FIRST)).alias("k")).select("k.route", "k.key", "fp")
    crowded = saved(first.groupBy("route", "key").agg(F.count("*").alias("n")).filter(F.col("n") > large).select("route", "key"), "crowded")
    if crowded.isEmpty():
        return first
    again = first.join(crowded, ["route", "key"], "left_semi")
    routes = [F.array(*[F.struct(F.lit(100 * (r + 1) + i).alias("route"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, m in enumerate(ms)]) for r, ms in enumerate(SECOND)]
    again = again.select("fp", F.explode(F.element_at(F.array(*routes), F.col("route") + 1)).alias("k")).select("k.route", "k.key", "fp")
    return first.join(crowded, ["route", "key"], "left_anti").unionByName(again)


def links(distinct: DataFrame, large: int = 1 << 14, held: int = 1 << 18) -> DataFrame:
    """Edges (a, b) that connect all fingerprints at a distance of 3 or less, as far as they are reachable."""
    return linked(routed(distinct, large), [], DISTANCE, 12, held)


def linked(rows: DataFrame, words: list[str], distance: int, small: int, held: int, pick=forest) -> DataFrame:
    """What pick() makes of the links within the groups of (route, key): fp names a row, the words are its bits (without any, fp itself)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0

        def done(rows: list[np.ndarray]) -> pa.RecordBatch:
            all_rows = np.concatenate(rows, 1)
            groups = np.cumsum(np.concatenate(([0], np.any(all_rows[:2, 1:] != all_rows[:2, :-1], axis=0))))
            bits = np.ascontiguousarray(all_rows[3:].T).view(np.uint64) if words else None
            a, b = group_links(groups, all_rows[2].view(np.uint64), bits, distance, small, pick)
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("route", "key", "fp", *words)])
            if n + rows.shape[1] > held and waiting:  # what has ended is linked; the last group goes on
                both = np.concatenate([*waiting, rows], 1)
                last = np.flatnonzero(np.any(both[:2] != both[:2, -1:], axis=0))
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield done([both[:, :cut]])
                waiting, n = [both[:, cut:]], both.shape[1] - cut
            else:
                waiting.append(rows)
                n += rows.shape[1]
        if n:
            yield done(waiting)

    spark = rows.sparkSession
    arrow_batches(spark, 1 << 14)
    return rows.select("route", "key", "fp", *words).repartition(shuffle_partitions(spark), "route", "key").sortWithinPartitions("route", "key").mapInArrow(lean(find), "a bigint, b bigint")


def connected(edges: DataFrame, most: int = 60) -> DataFrame:
    """v and root, the smallest value that v is connected to, for each value in edges (a, b), by large and small stars. Rounds leave nothing behind but their result."""
    spark = edges.sparkSession
    now = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(most):
        with temporary(spark):
            both = now.union(now.select("b", "a"))
            least = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "stars")
            large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
            large = saved(large, "large")
            low = saved(large.groupBy("a").agg(F.min("b").alias("m")), "low")
            small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
            now = saved(small, "edges", lasting=True)
        new = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            return now.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())
        state = new
    raise RuntimeError("the links did not settle")


def components(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id that is reachable over links.

    A text without words, empty or null has fingerprint 0 and is linked like any other. A null doc_id is
    never the smallest; a component of nulls alone has a null component_id. Repeated rows are rows of one
    component. An empty table gives an empty result. Other columns are not read.
    """
    fps = saved(fingerprints(docs, words, seed), "fingerprints")
    return labelled(fps, lambda distinct: links(distinct)).select("doc_id", "fp", "component_id")


def labelled(fps: DataFrame, find) -> DataFrame:
    """fps (doc_id, fp, ...) with component_id, over the links that find() gives for the distinct rows of fp."""
    bits = [F.first(c).alias(c) for c in fps.columns if c in WORDS] + [F.min(F.struct(*PLACE)).alias("at") for _ in [0] if set(PLACE) <= set(fps.columns)]
    with temporary(fps.sparkSession):
        distinct = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), *bits), "distinct")
        roots = saved(connected(find(distinct)), "roots")
        rooted = distinct.select("fp", "first").join(roots.withColumnRenamed("v", "fp"), "fp")
        least = saved(rooted.groupBy("root").agg(F.min("first").alias("least")), "least")
        grouped = saved(rooted.join(least, "root").select("fp", "least"), "linked")
        labels = saved(distinct.select("fp", "first").join(grouped, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "labels", lasting=True)
    return fps.join(labels, "fp")


#: Texts are near-duplicates where their sets of shingles have this similarity, by Jaccard.
SIMILAR = 0.8
#: Bits of a wide fingerprint. Of two texts at SIMILAR a share of APART differ on average (0.5 for unlike
#: texts); pairs that differ in LINKED of them at most are candidates, which is 3.6 deviations more.
WIDE, APART, LINKED = 256, 0.152, 60
WORDS = [f"w{i}" for i in range(WIDE // 64)]
#: Rows of a crowded group that all its others meet first; shingles that are compared as bits at once.
LEADERS, SHINGLES_AT_ONCE = 32, 1 << 14
PLACE = ["__path", "__row"]


def sampled_masks(rows: int, recall: float = 0.99, seed: int = 4) -> list[list[int]]:
    """Samples of bits for as many groupings that a pair at APART agrees in one of them with that probability, whatever the number of rows; more rows have more bits in a sample, so that groups stay small, and more groupings."""
    bits = int(np.clip(np.ceil(np.log2(max(2, rows))) - 6, 14, 24))
    times = int(np.ceil(np.log(1 - recall) / np.log(1 - (1 - APART) ** bits)))
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(times):
        chosen = rng.choice(WIDE, bits, replace=False)
        out.append([sum(1 << int(b) % 64 for b in chosen if b // 64 == w) for w in range(WIDE // 64)])
    return out


def keyed_rows(distinct: DataFrame, masks_: list[list[int]]) -> DataFrame:
    """Each row under the hash of its sampled bits in each grouping."""
    keyed = F.array(*[F.struct(F.lit(r).alias("route"), F.xxhash64(*[F.col(w).bitwiseAND(F.lit(signed(m))) for w, m in zip(WORDS, ms) if m]).alias("key")) for r, ms in enumerate(masks_)])
    return distinct.select("fp", *WORDS, F.explode(keyed).alias("k")).select("k.route", "k.key", "fp", *WORDS)


def candidates(distinct: DataFrame, most: int) -> DataFrame:
    """Edges (a, b) that connect all fp whose wide fingerprints agree in a sample of bits and differ in at most LINKED, by an index in Gray order.

    The rows of a group of over `most` rows, about, all count as connected, so that none is held at once. Such
    groups are found by every 16th fp.
    """
    rows = keyed_rows(distinct, sampled_masks(distinct.count()))
    seen = rows.filter(F.pmod(F.xxhash64("fp"), F.lit(16)) == 0).groupBy("route", "key").agg((16 * F.count("*")).alias("n"))
    crowded = saved(seen.filter(F.col("n") > most).select("route", "key"), "crowded")
    if crowded.isEmpty():
        return linked(rows, WORDS, LINKED, 48, 1 << 17, spanning).distinct()
    hot = rows.join(crowded, ["route", "key"], "left_semi").select("route", "key", "fp")
    first = hot.groupBy("route", "key").agg(F.min("fp").alias("b"))
    edges = hot.join(first, ["route", "key"]).select(F.col("fp").alias("a"), "b")
    return linked(rows.join(crowded, ["route", "key"], "left_anti"), WORDS, LINKED, 48, 1 << 17, spanning).unionByName(edges).distinct()


class Members:
    """Rows of a group of candidates: names, wide fingerprints, and sets of shingles as numbers of their own."""

    def __init__(self, names: np.ndarray, fps: np.ndarray, sets: list[np.ndarray]):
        by = np.argsort(gray_rank(fps[:, 0]), kind="stable")
        self.names, self.fps, self.sets = names[by], fps[by], [sets[k] for k in by]
        self.sizes = np.array([len(x) for x in self.sets], np.int64)

    def alike(self, x: np.ndarray, other: Members, y: np.ndarray) -> np.ndarray:
        """Whether the sets of rows x of these and y of others have the similarity SIMILAR, exactly."""
        small, large = np.minimum(self.sizes[x], other.sizes[y]), np.maximum(self.sizes[x], other.sizes[y])
        out = small >= SIMILAR * large - 1e-9
        left = np.flatnonzero(out)
        if not len(left):
            return out
        own, of_own = np.unique(x[left], return_inverse=True)
        its, of_its = np.unique(y[left], return_inverse=True)
        entries = int(self.sizes[own].sum() + other.sizes[its].sum())
        if 150 * len(left) < entries:  # few pairs
            both = np.array([len(np.intersect1d(self.sets[a], other.sets[b], assume_unique=True)) for a, b in zip(x[left], y[left])], np.int64)
        else:  # many pairs of few rows: bits of the shingles that occur on both sides
            shared = np.intersect1d(np.concatenate([self.sets[k] for k in own]), np.concatenate([other.sets[k] for k in its]))
            both = np.zeros(len(left), np.int64)
            for at in range(0, len(shared), SHINGLES_AT_ONCE):
                part = shared[at : at + SHINGLES_AT_ONCE]
                p, q = (marked([m.sets[k] for k in rows], part) for m, rows in ((self, own), (other, its)))
                for k in range(0, len(left), step := max(1, (1 << 22) // p.shape[1])):
                    both[k : k + step] += np.bitwise_count(p[of_own[k : k + step]] & q[of_its[k : k + step]]).sum(1, dtype=np.int64)
        total = self.sizes[x[left]] + other.sizes[y[left]]
        out[left] = both >= SIMILAR * (total - both) - 1e-9
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Edges that connect all rows at SIMILAR: leaders take what is like them, the index gives the pairs between what they took."""
        label = led(self.fps, LINKED, lambda x, y: self.alike(x, self, y))
        taken = np.flatnonzero(label != np.arange(len(label)))
        found = [(self.names[label[taken]], self.names[taken])]
        order = np.argsort(label, kind="stable")
        if len(order) and label[order[0]] != label[order[-1]]:
            for i, j in GrayIndex(self.fps[order], label[order]).links(LINKED):
                i, j = order[i], order[j]
                yes = self.alike(i, self, j)
                found.append(spanning(self.names[i[yes]], self.names[j[yes]]))
        return spanning(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))


def marked(sets: list[np.ndarray], shingles: np.ndarray) -> np.ndarray:
    """A row of bits for each set: which of the shingles (ascending) it has."""
    sizes, every = [len(x) for x in sets], np.concatenate(sets)
    place = np.minimum(np.searchsorted(shingles, every), len(shingles) - 1)
    row, hit = np.repeat(np.arange(len(sets)), sizes), shingles[place] == every
    out = np.zeros((len(sets), -(-len(shingles) // 64)), np.uint64)
    np.bitwise_or.at(out, (row[hit], place[hit] // 64), np.uint64(1) << (place[hit] % 64).astype(np.uint64))
    return out


def members_of(rows: list[pa.RecordBatch]) -> Members:
    every = pa.concat_batches(rows)
    fps = np.stack([every.column(w).to_numpy() for w in WORDS], 1).view(np.uint64)
    return Members(every.column("fp").to_numpy(), np.ascontiguousarray(fps), [np.frombuffer(x.as_buffer(), "<u8") for x in every.column("shingles")])


def runs_of(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of sorted batches with the same values of the columns."""
    for batch in batches:
        if batch.num_rows:
            keys = np.stack([batch.column(c).to_numpy() for c in columns])
            cuts = [0, *(np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                yield tuple(keys[:, a].tolist()), batch.slice(a, b - a)


def edges_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def within(members: DataFrame) -> DataFrame:
    """Edges between the members (root, fp, words, shingles) of each root, which are few, that connect all at SIMILAR."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, held = None, []
        for key, part in runs_of(batches, ["root"]):
            if key != root and held:
                yield edges_of(*members_of(held).links())
                held = []
            root = key
            held.append(part)
        if held:
            yield edges_of(*members_of(held).links())

    arrow_batches(members.sparkSession)
    dealt = members.repartition(shuffle_partitions(members.sparkSession), "root").sortWithinPartitions("root")
    return dealt.mapInArrow(lean(find), "a bigint, b bigint")


def met(residents: DataFrame, queries: DataFrame) -> DataFrame:
    """Edges between queries and residents (root, salt, part, fp, words, shingles) of one block and different parts at SIMILAR. Residents are bounded, queries stream past."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, index = None, [], None
        for key, part in runs_of(batches, ["root", "salt", "role"]):
            if key[:2] != block:
                block, held, index = key[:2], [], None
            if not key[2]:
                held.append(part)
                continue
            if not held:
                continue
            if index is None:
                own = pa.concat_batches(held)
                own = own.take(pa.array(np.argsort(own.column("part").to_numpy(), kind="stable")))
                there = members_of([own])
                parts = own.column("part").to_numpy()[np.argsort(gray_rank(np.ascontiguousarray(own.column(WORDS[0]).to_numpy()).view(np.uint64)), kind="stable")]
                order = np.argsort(parts, kind="stable")
                index = GrayIndex(there.fps[order], parts[order])
            asked = members_of([part])
            own_part = part.column("part").to_numpy()[np.argsort(gray_rank(np.ascontiguousarray(part.column(WORDS[0]).to_numpy()).view(np.uint64)), kind="stable")]
            for q, row in index.near(asked.fps, LINKED, own_part):
                yes = asked.alike(q, there, order[row])
                yield edges_of(*spanning(asked.names[q[yes]], there.names[order[row[yes]]]))

    arrow_batches(residents.sparkSession)
    place = ["root", "salt", "role"]
    rows = residents.withColumn("role", F.lit(0)).unionByName(queries.withColumn("role", F.lit(1))).select(*place, "part", "fp", *WORDS, "shingles")
    return rows.repartition(shuffle_partitions(rows.sparkSession), *place[:2]).sortWithinPartitions(*place).mapInArrow(lean(find), "a bigint, b bigint")


def across(members: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """Edges between the members of roots that have many (sizes: root, n), in blocks of about `most`.

    First all meet the LEADERS of their root. Then what is not of the root's main part by that meets all blocks.
    """
    hot = saved(members.join(sizes.withColumn("blocks", F.ceil(F.col("n") / most).cast("int")).drop("n"), "root"), "hot")
    salted = lambda df: df.withColumn("salt", F.pmod(F.xxhash64("fp", F.lit(5)), F.col("blocks")).cast("int"))
    everywhere = lambda df: df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.xxhash64("fp"), "fp"))
    leaders = hot.select("root", "fp").withColumn("r", rank).filter(F.col("r") <= LEADERS).select("root", "fp")
    own = hot.withColumn("part", F.col("fp"))
    first = saved(met(everywhere(own.join(leaders, ["root", "fp"], "left_semi")), salted(own)), "first")
    parts = connected(first).select(F.col("v").alias("fp"), F.col("root").alias("p"))
    own = saved(hot.join(parts, "fp", "left").withColumn("part", F.coalesce("p", "fp")).drop("p"), "parted")
    main = own.groupBy("root", "part").agg(F.count("*").alias("n")).groupBy("root").agg(F.max_by("part", F.struct("n", "part")).alias("main"))
    return first.unionByName(met(salted(own), everywhere(own.join(main, "root").filter("part <> main").drop("main"))))


def similar_links(distinct: DataFrame, texts: DataFrame, words: int, seed: int, most: int) -> DataFrame:
    """Edges that connect all texts at SIMILAR, verified on their sets of shingles.

    Texts that could be similar make groups: what candidates() connects. Of each distinct text in a group the
    set is made where the text lies (`at` in distinct; texts have text, __path and __row), and dealt by group.
    """
    spark = distinct.sparkSession
    grouped = saved(connected(candidates(distinct, 4 * most)), "candidates")
    chosen = distinct.join(grouped.withColumnRenamed("v", "fp"), "fp").select("at.*", "fp", "root")
    folder = noted(chosen, ["fp", "root"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notes = Notes(folder)
        for batch in batches:
            at, found = notes.find(batch)
            if not len(at):
                continue
            kept = batch.column("text").take(pa.array(at)).to_pylist()
            prints = [wide_fingerprint(t, words, seed)[1] for t in kept]
            sets = [shingle_set(t, words, seed).tobytes() for t in kept]
            yield pa.record_batch([found.column("root"), found.column("fp"), *word_columns(prints), pa.array(sets, pa.binary())], names=["root", "fp", *WORDS, "shingles"])

    arrow_batches(spark)
    schema = "root bigint, fp bigint, " + ", ".join(f"{w} bigint" for w in WORDS) + ", shingles binary"
    members = saved(texts.mapInArrow(lean(each), schema), "shingles", "none")
    big = saved(grouped.groupBy("root").agg(F.count("*").alias("n")).filter(F.col("n") > most), "big")
    if big.isEmpty():
        return within(members)
    return within(members.join(big, "root", "left_anti")).unionByName(across(members, big, most))


def word_columns(prints: list[bytes]) -> list[pa.Array]:
    bits = np.frombuffer(b"".join(prints), ">u8").reshape(-1, len(WORDS)).astype(np.uint64).view(np.int64)
    return [pa.array(np.ascontiguousarray(bits[:, i])) for i in range(len(WORDS))]


def similar(docs: DataFrame, words: int = 5, seed: int = 42, crowded: int = 1 << 12) -> DataFrame:
    """doc_id, fp (a hash of the distinct shingles), component_id, __key (a digest of the text), __path and __row (where the row is stored): components of texts whose sets of shingles have a similarity of 0.8 or more.

    Groups of over `crowded` candidates are dealt in blocks. docs has __path and __row, or gets them. Nulls,
    empty texts, repeats and empty tables as for components().
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wide_fingerprint(t, words, seed) for t in batch.column("text").to_pylist()]
            fps = pa.array(np.array([f for f, _ in found], np.uint64).view(np.int64))
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "__key", *PLACE)), fps, *word_columns([w for _, w in found])], names=["doc_id", "__key", *PLACE, "fp", *WORDS])

    docs = docs if set(PLACE) <= set(docs.columns) else located(docs)
    arrow_batches(docs.sparkSession)
    schema = "doc_id bigint, __key string, __path string, __row bigint, fp bigint, " + ", ".join(f"{w} bigint" for w in WORDS)
    texts = docs.select(F.col("doc_id").cast("bigint"), "text", *PLACE)
    keyed = texts.withColumn("__key", F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")))
    fps = saved(keyed.mapInArrow(lean(each), schema), "wide-fingerprints")
    return labelled(fps, lambda distinct: similar_links(distinct, texts.drop("doc_id"), words, seed, crowded)).select("doc_id", "fp", "component_id", "__key", *PLACE)


def without_copies(docs: DataFrame, words: int = 5) -> DataFrame:
    """The rows of docs without those that are similar to a smaller doc_id: one document of each component stays.

    Each text of a doc_id is judged by itself. Rows with the doc_id that stays and the same text are reduced
    to one. Rows with a null doc_id go if their component has another doc_id, and stay if not. What goes is
    noted for the files that hold the rows: no text is shuffled.
    """
    columns, docs = docs.columns, located(docs)
    with temporary(docs.sparkSession):
        found = saved(similar(docs, words), "similar", lasting=True)
    copy = F.coalesce(F.col("doc_id") != F.col("component_id"), F.col("component_id").isNotNull())
    again = found.filter(~copy & F.col("doc_id").isNotNull()).groupBy("doc_id", "__key").agg(F.count("*").alias("n"), F.min(F.struct(*PLACE)).alias("one")).filter("n > 1")
    again = found.join(again, ["doc_id", "__key"]).filter(F.struct(*PLACE) != F.col("one"))
    gone = noted(found.filter(copy).select(*PLACE).unionByName(again.select(*PLACE)).distinct(), [])
    schema = docs.schema

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notes = Notes(gone)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[notes.find(batch)[0]] = False
            yield batch.filter(pa.array(keep))

    arrow_batches(docs.sparkSession)
    return docs.mapInArrow(lean(stay), schema).select(*columns)
