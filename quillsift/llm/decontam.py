"""Benchmark passages in documents, found by CGK embedding and bit-sampling LSH, verified by edit distance.

The CGK walk reads a string with a pointer: at step j it writes the byte under the pointer and moves on by
0 or 1, as a random function of j and the byte says. Two strings at a small edit distance fall in step
again after each edit, so their walks differ in few coordinates: edit distance becomes Hamming distance. A
repetition has its own walk and its own sample of coordinates; the bytes there, hashed, are the key.

At 15 % of edits one walk over a whole window of an item's size differs in 0.4 to 0.7 of its coordinates,
so that no sample of a useful size stays equal in a payable number of repetitions. Therefore the walk
begins anew at each byte of an item-sized window, and a key samples the first steps of one of these walks.
How many steps, and in how many repetitions, follows from the item's size, the edits allowed and TARGET:
the longest walk with which a simulation on edited texts of that size meets at least once with that
probability (`plan`). Documents have a walk from every byte too, so nothing depends on words or spaces.

A meeting tells the place where the item would lie. Places are counted once for each stretch as long as the
edits allowed; what shares too few 5-byte strings with the item to be within them is left; the rest is
decided by the exact edit distance of the item to the best string there, by Myers' bit vectors.

Texts are compared in lower case with runs of anything but letters and digits as one space. An item matches
at no more than (1 - similarity) of its length in edits. Items under SHORT bytes match as whole words only:
so short a string is within its edits of much that is no copy. Null and empty texts and items match
nothing. Repeated and null ids are kept apart by their text's rows: each matching row gives its doc_id and
the item's item_id, once each. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, lean, ranges, utf8
from .tokens import together

SIMILARITY, TARGET = 0.85, 0.95
#: Steps that a key can sample from, the share of them that it does, and the most repetitions.
LEVELS, SAMPLED, REPETITIONS = (16, 18, 20, 22, 24, 28, 32, 38, 44), 0.7, 3
#: Items under this many bytes have no walk.
SHORT = 32
#: Windows that are walked at once, most bits of the table of first keys, bytes of items held at once.
AT_ONCE, SLOT_BITS, ITEMS_AT_ONCE = 1 << 14, 24, 2 << 20
#: Bytes of the strings that are counted, bits of their table, and places that are looked at at once.
GRAM, GRAM_BITS, GRAMS_AT_ONCE, ROWS_AT_ONCE = 5, 14, 1 << 21, 1 << 11
PADDING = LEVELS[-1]

FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = [c if chr(c).isalnum() else 32 for c in range(128)]
FOLD[65:91] += 32


def folded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts as compared, each between single spaces, and where each begins; bytes without a text follow."""
    data, offsets = utf8(pc.utf8_lower(pc.fill_null(texts, "")))
    out = np.full(len(data) + len(offsets), 32, np.uint8)
    at = np.arange(len(data))
    at += np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
    out[at] = FOLD[data]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 32) | (out[:-1] != 32)
    starts = np.cumsum(keep)[offsets + np.arange(len(offsets))] - 1  # the space before each text
    return np.concatenate((out[keep], np.zeros(PADDING, np.uint8))), starts


class Walk:
    """The walk and the sample of a repetition. Byte by byte: what a byte adds to the key, and the step after it."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.moves = rng.integers(0, 2, (LEVELS[-1], 256)).astype(bool)
        self.weights = rng.integers(1, 1 << 63, LEVELS[-1], dtype=np.uint64) | np.uint64(1)
        self.weights[rng.random(LEVELS[-1]) >= SAMPLED] = 0
        self.weights[0] |= np.uint64(1)
        self.tables = {steps: self.table(steps) for steps in LEVELS}

    def table(self, steps: int) -> tuple[np.ndarray, np.ndarray]:
        after, adds = np.full((steps + 1, 256), steps << 8, np.int64), np.zeros((steps + 1, 256), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(steps - 1, -1, -1):
                after[j] = np.where(self.moves[j], (j + 1) << 8, after[j + 1])
                adds[j] = self.weights[j] * np.arange(1, 257, dtype=np.uint64) + np.where(self.moves[j], np.uint64(0), adds[j + 1])
        return after.ravel(), adds.ravel()

    def keys(self, steps: int, byte, n: int, sizes: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Keys of n walks whose byte number i is byte(i), and with `sizes` how many bytes each read. A walk ends after its steps or reach(steps) bytes."""
        after, adds = self.tables[steps]
        at, key, read = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.int64) if sizes else None
        here, add = np.empty(n, np.int64), np.empty(n, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(reach(steps)):
                if sizes:
                    read += at < steps << 8
                np.bitwise_or(at, byte(i), out=here)
                key += adds.take(here, out=add, mode="clip")  # always within; clip is the fast mode
                after.take(here, out=at, mode="clip")
            return (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9), read


def reach(steps: int) -> int:
    """The most bytes that a walk reads; half of its steps on average."""
    return 5 * steps // 8


@lru_cache(1)
def walks() -> list[Walk]:
    return [Walk(5 + r) for r in range(REPETITIONS)]


@lru_cache(256)
def plan(size: int, edits: int, target: float = TARGET) -> tuple[int, int]:
    """Steps and repetitions for items of a size: the most steps with which one repetition reaches the target on texts with that many edits; else the fewest steps, in as many repetitions as do."""
    trials, rng = 300, np.random.default_rng(size)
    letters = np.frombuffer(b"etaoinshrdlucmfwypvbgk      ", np.uint8)
    own, other = letters[rng.integers(0, len(letters), (trials, size))], []
    for text in own:
        changed = text.tolist()
        for kind, c in zip(rng.integers(0, 3, edits), letters[rng.integers(0, len(letters), edits)]):
            p = int(rng.integers(0, len(changed)))
            changed[p : p + (kind != 0)] = [c] if kind < 2 else []
        other.append(np.array(changed, np.uint8))
    a, b = np.concatenate([own.ravel(), np.zeros(PADDING, np.uint8)]), np.concatenate([*other, np.zeros(PADDING, np.uint8)])
    a, b = a.astype(np.int64), b.astype(np.int64)
    of_a, of_b = np.repeat(np.arange(trials), size), np.repeat(np.arange(trials), [len(x) for x in other])
    left = np.tile(size - np.arange(size), trials)
    for steps in reversed(LEVELS):
        met = np.zeros(trials, bool)
        for r, w in enumerate(walks()):
            ka, read = w.keys(steps, lambda i: a[i : i + len(of_a)], len(of_a), True)
            kb, _ = w.keys(steps, lambda i: b[i : i + len(of_b)], len(of_b))
            mine = np.flatnonzero(read <= left)
            with np.errstate(over="ignore"):
                ka, kb = (k + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for k, of in ((ka[mine], of_a[mine]), (kb, of_b)))
            met[of_a[mine][np.isin(ka, kb)]] = True
            if met.mean() >= target:
                return steps, r + 1
            if steps > LEVELS[0]:
                break
    return LEVELS[0], REPETITIONS


def planned(size: int, similarity: float) -> tuple[int, int]:
    """The plan of the largest of a row of sizes, each a tenth over the one before, that is no larger: longer items meet more often."""
    at = SHORT
    while at + at // 10 <= min(size, 1000):
        at += at // 10
    return plan(at, int((1 - similarity) * at + 1e-9))


def best_distance(pattern: bytes, text: bytes, most: int) -> int:
    """The least edit distance of the pattern to any string within text, or most + 1: bit vectors by Myers."""
    if pattern in text:
        return 0
    n = len(pattern)
    ones, top = (1 << n) - 1, 1 << (n - 1)
    eq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    up, down, score, best = ones, 0, n, min(n, most + 1)
    for c in text:
        x = eq.get(c, 0)
        v = x | down
        h = (((x & up) + up) ^ up) | x
        hp = down | (ones & ~(h | up))
        hn = up & h
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1 & ones, hn << 1 & ones
        up, down = hn | (ones & ~(v | hp)), hp & v
        best = min(best, score)
    return best


@dataclass
class Level:
    """Walks of a length in a repetition: a table of the first bits of the keys of all windows with so many steps at least; and the windows with just as many, by key, with item and place in it."""

    steps: int
    slots: np.ndarray
    keys: np.ndarray
    item: np.ndarray
    within: np.ndarray


class Index:
    """Items with the keys of their windows."""

    def __init__(self, ids: list, texts: list[str | None], similarity: float):
        data, starts = folded(pa.array(texts, pa.string()))
        every = data.tobytes()
        self.ids = ids
        self.items = [every[a:b].strip(b" ") for a, b in zip(starts, starts[1:])]
        self.sizes = np.array([len(x) for x in self.items], np.int64)
        self.most = ((1 - similarity) * self.sizes + 1e-9).astype(np.int64)
        #: Places within as many bytes are one.
        self.bound = np.maximum(2, self.most)
        self.short = [k for k, x in enumerate(self.items) if 0 < len(x) < SHORT]
        long = np.flatnonzero(self.sizes >= SHORT)
        plans = np.array([planned(int(n), similarity) for n in self.sizes[long]], np.int64).reshape(-1, 2)
        self.bits = int(np.clip(np.ceil(np.log2(16 * max(1, self.sizes[long].sum()))), 12, SLOT_BITS))
        wide = data.astype(np.int64)
        self.levels: list[list[Level]] = []
        for r in range(int(plans[:, 1].max(initial=0))):
            walk, levels, rest = walks()[r], [], np.zeros(0, np.int64)
            for steps in np.unique(plans[plans[:, 1] > r, 0])[::-1].tolist():
                own = long[(plans[:, 0] == steps) & (plans[:, 1] > r)]
                at, item = ranges(starts[own] + 1, self.sizes[own]), np.repeat(own, self.sizes[own])
                within = ranges(np.zeros(len(own), np.int64), self.sizes[own])
                key, read = walk.keys(steps, lambda i, at=at: wide[at + i], len(at), True)
                inside = np.flatnonzero(within + read <= self.sizes[item])
                key, item, within, rest = key[inside], item[inside], within[inside], np.concatenate((rest, at[inside]))
                slots = np.zeros(1 << self.bits, bool)
                slots[self.slot(walk.keys(steps, lambda i, at=rest: wide[at + i], len(rest))[0])] = True
                # Of a key that an item has again and again, one in each stretch of its bound.
                by = np.lexsort((within, item, key))
                key, item, within = key[by], item[by], within[by]
                part = within // self.bound[item]
                new = np.concatenate(([True], (key[1:] != key[:-1]) | (item[1:] != item[:-1]) | (part[1:] != part[:-1])))
                levels.append(Level(steps, slots, key[new], item[new], within[new]))
            self.levels.append(levels[::-1])

    def slot(self, key: np.ndarray) -> np.ndarray:
        return (key >> np.uint64(64 - self.bits)).view(np.int64)

    def hits(self, data: np.ndarray, first: int, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place in the texts, item, place in the item) where walks from `first` on meet."""
        for walk, levels in zip(walks(), self.levels):
            at = None
            for level in levels:
                if at is None:
                    key, at = walk.keys(level.steps, lambda i: data[first + i : first + i + n], n)[0], np.arange(n)
                else:
                    key = walk.keys(level.steps, lambda i: data.take(at + (first + i)), len(at))[0]  # noqa: B023
                left = np.flatnonzero(level.slots.take(self.slot(key)))
                at, key = at[left], key[left]
                a, b = np.searchsorted(level.keys, key, side="left"), np.searchsorted(level.keys, key, side="right")
                some = np.flatnonzero(b > a)
                if len(some):
                    each = ranges(a[some], (b - a)[some])
                    yield np.repeat(at[some] + first, (b - a)[some]), level.item[each], level.within[each]

    def places(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Columns: row, item, number of the stretch of the item's bound (from its size before the text on) that was pointed to; each once."""
        end, found = int(starts[-1]), [np.zeros((3, 0), np.int64)]
        for first in range(0, end, AT_ONCE):
            for at, item, within in self.hits(data, first, min(AT_ONCE, end - first)):
                row = np.searchsorted(starts, at, side="right") - 1
                found.append(np.unique(np.stack((row, item, (at - within - starts[row] + self.sizes[item]) // self.bound[item])), axis=1))
        return np.unique(np.concatenate(found, axis=1), axis=1)

    def regions(self, places: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that hold all strings within the edits whose walks point to these places."""
        row, item, stretch = places
        bound, most, size = self.bound[item], self.most[item], self.sizes[item]
        low = starts[row] - size + stretch * bound
        return np.maximum(starts[row], low - bound - most), np.minimum(starts[row + 1] + 1, low + bound + size + most)

    def likely(self, data: np.ndarray, places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which regions share as many strings of GRAM bytes with the item as one within its edits does at least (an edit takes GRAM of them), counted in the region and in the item."""
        item, gram = places[1], gram_codes(data)
        need = self.sizes[item] + 1 - GRAM - GRAM * self.most[item]
        many = np.maximum(0, high - low - GRAM + 1)
        own = self.sizes[item] - GRAM + 1
        out = np.arange(len(item))

        def shared(of: np.ndarray, known_at: np.ndarray, known: np.ndarray, at: np.ndarray, n: np.ndarray, codes: np.ndarray, grams: np.ndarray) -> np.ndarray:
            """How many of each row's grams (n of codes from `at` on) are among those marked in its line (known of grams from known_at on) of a table."""
            table = np.zeros((len(known), 1 << GRAM_BITS), bool)
            table[np.repeat(np.arange(len(known)), known), grams[ranges(known_at, known)]] = True
            has = np.concatenate(([0], np.cumsum(table[np.repeat(of, n), codes[ranges(at, n)]])))
            ends = np.cumsum(n)
            return has[ends] - has[ends - n]

        texts, which = np.unique(item, return_inverse=True)
        grams = [gram_codes(np.frombuffer(self.items[i], np.uint8).astype(np.int64))[: 1 - GRAM] for i in texts]
        starts = np.concatenate(([0], np.cumsum([len(g) for g in grams]))).astype(np.int64)
        grams = np.concatenate([*grams, np.zeros(0, np.int64)])
        for side in (0, 1):
            stay = []
            cuts = np.searchsorted(np.cumsum(many[out]), np.arange(GRAMS_AT_ONCE, int(many[out].sum()) + GRAMS_AT_ONCE, GRAMS_AT_ONCE), side="right")
            for k in np.split(out, cuts):
                for c in np.split(k, np.arange(ROWS_AT_ONCE, len(k), ROWS_AT_ONCE)):
                    if side:
                        found = shared(np.arange(len(c)), low[c], many[c], starts[which[c]], own[c], grams, gram)
                    else:
                        one, of = np.unique(which[c], return_inverse=True)
                        found = shared(of, starts[one], starts[one + 1] - starts[one], low[c], many[c], gram, grams)
                    stay.append(c[found >= need[c]])
            out = np.concatenate(stay) if stay else out
        yes = np.zeros(len(item), bool)
        yes[out] = True
        return yes

    def matches(self, texts: pa.Array) -> list[tuple[int, int, int]]:
        """(row, item, edits) of each item in each text."""
        data, starts = folded(texts)
        found: dict[tuple[int, int], int] = {}
        wide = data.astype(np.int64)
        places = self.places(wide, starts)
        low, high = self.regions(places, starts)
        yes = self.likely(wide, places, low, high)
        for r, k, a, b in zip(places[0][yes].tolist(), places[1][yes].tolist(), low[yes].tolist(), high[yes].tolist()):
            most = int(self.most[k])
            now = found.get((r, k), most + 1)
            if now:
                found[r, k] = min(now, best_distance(self.items[k], data[a:b].tobytes(), most))
        out = [(r, k, d) for (r, k), d in found.items() if d <= self.most[k]]
        if self.short:
            every = data.tobytes()
            for r, (a, b) in enumerate(zip(starts.tolist(), starts[1:].tolist())):
                out += [(r, k, 0) for k in self.short if b" " + self.items[k] + b" " in every[a : b + 1]]
        return sorted(out)


def gram_codes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    out = data.copy()
    for k in range(1, GRAM):
        out *= 131
        out[:-k] += data[k:]
    return (out >> 3 ^ out) & ((1 << GRAM_BITS) - 1)


def indexes(items: DataFrame, similarity: float) -> Iterator[Index]:
    """The items, in blocks of bounded size."""
    items = items.select(F.col("item_id").cast("bigint"), "text").filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // ITEMS_AT_ONCE))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("item_id", "text").toArrow()
        yield Index(rows.column("item_id").to_pylist(), rows.column("text").to_pylist(), similarity)


def leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, edits and item_bytes of each benchmark item in each document."""
    schema = "doc_id bigint, item_id bigint, edits bigint, item_bytes bigint"
    docs = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    arrow_batches(docs.sparkSession)
    out = None
    for index in indexes(items, similarity):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in together(batches, least=4 << 20):
                index, ids = shared.value, batch.column("doc_id").to_pylist()
                rows = [(ids[r], index.ids[k], d, len(index.items[k])) for r, k, d in index.matches(batch.column("text"))]
                yield pa.record_batch([pa.array([x[i] for x in rows], pa.int64()) for i in range(4)], names=["doc_id", "item_id", "edits", "item_bytes"])

        part = docs.mapInArrow(lean(find), schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs, with all their columns, that hold no benchmark item."""
    arrow_batches(docs.sparkSession)
    for index in indexes(items, similarity):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in together(batches, least=4 << 20):
                stay = np.ones(batch.num_rows, bool)
                stay[[r for r, _, _ in shared.value.matches(batch.column("text"))]] = False
                yield batch.filter(pa.array(stay))

        docs = docs.mapInArrow(lean(keep), docs.schema)
    return docs
