"""Language of a text by its words first, by shorter and shorter character n-grams for words not seen.

A known word adds its log frequency in each language. A word not seen falls back to its character 5-grams
(with marks at both ends); if none of them is known, to 4-grams, and so on to single characters; the mean
log frequency of the known n-grams of that order counts. The language of the highest sum wins, ties go to
the first by name; the score is its share by the mean over the words, as of `evidence` words at most: more
of them would make every score one.

Words and n-grams are looked up as 64-bit hashes of their code points in sorted arrays, all the words of a
part of a batch at once, each distinct one once. A part has PART bytes; a longer text is cut at blanks and
its parts are added up.

A null text, or one without a letter, is `und` with score 0. Rows with a null lang or a null doc_id are not
learned from, repeated rows count each time. With nothing learned every text is `und`. An empty table gives
an empty result. lang, source and doc_id are no inputs of a prediction.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, lean, ranges, saved, shuffle_partitions, utf8

UND = "und"
#: Bounds of the model: documents learned from in each language, words and n-grams kept of each language.
DOCUMENTS, WORDS, GRAMS = 2_000, 20_000, 20_000
ORDERS = (5, 4, 3, 2, 1)
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Bytes of texts whose words are looked up at once.
PART = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
FIRST, LAST = ord("^"), ord("$")


def grams(word: str, order: int) -> list[str]:
    marked = f"^{word}$" if order > 1 else word
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


@lru_cache(1)
def kinds() -> np.ndarray:
    """1 for letters, 2 for marks, by code point."""
    out = np.zeros(0x110000, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        text = "".join(map(chr, range(low, high)))
        for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{M}+")):
            for m in regex.finditer(pattern, text):
                out[low + m.start() : low + m.end()] = kind
    return out


class Powers:
    """Powers of BASE and of its inverse, as many as were asked for so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            one, back = np.ones(1, np.uint64), np.uint64(pow(int(BASE), -1, 1 << 64))
            with np.errstate(over="ignore"):
                cls.up, cls.down = (np.cumprod(np.concatenate((one, np.full(n, x, np.uint64)))) for x in (BASE, back))
        return cls.up, cls.down


def run_hashes(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each run of code points."""
    up, down = Powers.of(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
        out = (sums[starts + lengths] - sums[starts]) * down[starts]
        out = (out ^ (out >> np.uint64(32))) * BASE
    return out ^ (out >> np.uint64(29))


def points_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of texts in a row, and how many each has."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"), np.fromiter(map(len, texts), np.int64, len(texts))


def words_of(points: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and how long they are, in texts that begin at `begins`: from a letter on, as far as letters and marks go."""
    kind = kinds()[points]
    some = kind > 0
    new = some.copy()
    new[1:] &= ~some[:-1]
    new[begins[begins < len(points)]] = True
    new &= some
    first = np.flatnonzero(new)
    stop = ~some
    stop[begins[begins < len(points)]] = True
    ends = np.append(np.flatnonzero(stop), len(points))
    end = ends[np.searchsorted(ends, first, side="right")]
    letters = np.append(np.flatnonzero(kind == 1), len(points))
    first = letters[np.searchsorted(letters, first)]  # past marks before it
    has = np.flatnonzero(first < end)
    return first[has], (end - first)[has]


@dataclass
class Table:
    """Log frequencies by language (columns) of entries, by their hashes in ascending order."""

    keys: np.ndarray
    scores: np.ndarray

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are known, and the rows of those."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return known, at[known]


def table(entries: list[str], scores: np.ndarray) -> Table:
    points, lengths = points_of(entries)
    keys = run_hashes(points, np.cumsum(lengths) - lengths, lengths)
    by = np.argsort(keys)
    return Table(keys[by], scores[by])


@dataclass
class Model:
    languages: list[str]
    words: Table
    grams: dict[int, Table]
    evidence: int = 12

    def unseen(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The scores of words that are not known, by their n-grams."""
        marked = np.full(int(lengths.sum()) + 2 * len(starts), LAST, np.uint32)
        at = np.cumsum(lengths + 2) - (lengths + 2)
        marked[at] = FIRST
        marked[ranges(at + 1, lengths)] = points[ranges(starts, lengths)]
        out, left = np.zeros((len(starts), len(self.languages)), np.float32), np.arange(len(starts))
        for order in ORDERS:
            if not len(left) or order not in self.grams:
                continue
            first, many = (at[left] + 1, lengths[left]) if order == 1 else (at[left], np.maximum(0, lengths[left] + 3 - order))
            where = ranges(first, many)
            known, rows = self.grams[order].find(run_hashes(marked, where, np.full(len(where), order)))
            of = np.repeat(np.arange(len(left)), many)[known]
            n = np.bincount(of, minlength=len(left))
            yes, scores = n > 0, self.grams[order].scores
            for j in range(len(self.languages)):
                out[left[yes], j] = (np.bincount(of, scores[rows, j], minlength=len(left))[yes] / n[yes]).astype(np.float32)
            left = left[~yes]
        return out

    def totals(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """For each text its sum in each language, and its number of words. The texts are in lower case."""
        points = np.frombuffer(data.decode().encode("utf-32-le"), "<u4")
        chars = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
        begins = chars[offsets]
        starts, lengths = words_of(points, begins[:-1])
        out = np.zeros((len(offsets) - 1, len(self.languages) + 1))
        if not len(starts):
            return out
        keys, one, of = np.unique(run_hashes(points, starts, lengths), return_index=True, return_inverse=True)
        scores = np.zeros((len(keys), len(self.languages)), np.float32)
        known, rows = self.words.find(keys)
        scores[known] = self.words.scores[rows]
        rest = one[~known]
        scores[~known] = self.unseen(points, starts[rest], lengths[rest])
        text = np.searchsorted(begins, starts, side="right") - 1
        for j in range(len(self.languages)):
            out[:, j] = np.bincount(text, scores[of, j], minlength=len(out))
        out[:, -1] = np.bincount(text, minlength=len(out))
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        if not self.languages or not n:
            return [UND] * n, np.zeros(n)
        data, offsets = utf8(pc.utf8_lower(pc.fill_null(texts, "")))
        totals = np.zeros((n, len(self.languages) + 1))
        for first, last, a, b in parts(data, offsets):
            inner = np.clip(offsets[first : last + 1], a, b) - a
            totals[first:last] += self.totals(data[a:b].tobytes(), inner)
        words, totals = totals[:, -1], totals[:, :-1]
        best = totals.argmax(1)
        mean = (totals - totals.max(1, keepdims=True)) / np.maximum(words, 1)[:, None] * np.minimum(words, self.evidence)[:, None]
        share = 1 / np.exp(np.clip(mean, -60, 0)).sum(1)
        return [self.languages[b] if w else UND for b, w in zip(best, words)], np.where(words > 0, share, 0.0)


def parts(data: np.ndarray, offsets: np.ndarray, size: int = PART) -> Iterator[tuple[int, int, int, int]]:
    """(first text, text after the last, first byte, byte after the last) of parts of about a size; a longer text is cut after blanks, without any between characters."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        a, end = int(offsets[first]), int(offsets[last])
        while end - a > size and last == first + 1:
            b = a + size
            blank = np.flatnonzero(data[a:b] == 32)
            if len(blank):
                b = a + int(blank[-1]) + 1
            while b < end and data[b] & 0xC0 == 0x80:
                b += 1
            yield first, last, a, b
            a = b
        yield first, last, a, end
        first = last


def log_frequencies(counts: dict[str, Counter], totals: dict[str, int], languages: list[str], rest: float) -> tuple[list[str], np.ndarray]:
    """The entries and their smoothed log frequencies in all languages."""
    entries = sorted({e for c in counts.values() for e in c})
    out = np.zeros((len(entries), len(languages)), np.float32)
    for j, l in enumerate(languages):
        total = totals.get(l, 0) + rest * max(1, len(entries))
        out[:, j] = np.log([(counts[l][e] + rest) / total for e in entries]) if entries else 0
    return entries, out


def commonest(counted: DataFrame, most: int) -> tuple[dict[str, Counter], dict[str, int]]:
    """Counts, in every language, of the entries (lang, entry, n) that are among the commonest of one; and each language's total."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "entry"))
    kept = counted.withColumn("r", rank).filter(F.col("r") <= most).select("entry").distinct()
    rows = counted.join(kept, "entry", "left_semi").select("lang", "entry", "n").toArrow()  # at most `most` entries of each language
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    out = {l: Counter() for l in totals}
    for lang, entry, n in zip(*(rows.column(c).to_pylist() for c in ("lang", "entry", "n"))):
        out[lang][entry] = n
    return out, totals


COUNTED = "lang string, entry string, n bigint"


def learn(docs: DataFrame, learned, per_language: int = DOCUMENTS, words: int = WORDS, n_grams: int = GRAMS) -> Model:
    """A model from rows for which the condition `learned` holds: a bounded sample of each language, by a hash of doc_id."""
    rows = docs.select("doc_id", "text", "lang").filter(learned & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    languages = sorted(sizes)
    share = F.coalesce(*[F.when(F.col("lang") == l, F.lit(min(1.0, per_language / sizes[l]))) for l in languages], F.lit(0.0)) if languages else F.lit(0.0)
    sample = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30)) <= share * (1 << 30)).select("lang", F.coalesce("text", F.lit("")).alias("text"))

    def counter(entries_of):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[str, Counter] = {}
            for batch in batches:
                entries_of(batch, lambda lang: found.setdefault(lang, Counter()))
            rows = [(lang, e, n) for lang, c in found.items() for e, n in c.items()]
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "entry", "n"])

        return count

    def own_words(batch: pa.RecordBatch, of) -> None:
        for lang, text in zip(batch.column("lang").to_pylist(), pc.utf8_lower(batch.column("text")).to_pylist()):
            of(lang).update(WORD.findall(text))

    def own_grams(batch: pa.RecordBatch, of) -> None:
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "entry", "n"))):
            counts = of(lang)
            for order in ORDERS:
                for g in grams(word, order):
                    counts[f"{order}{g}"] += n

    arrow_batches(docs.sparkSession)
    total = lambda df: saved(df.groupBy("lang", "entry").agg(F.sum("n").alias("n")), "counted")
    counted = total(sample.mapInArrow(lean(counter(own_words)), COUNTED))
    counts, totals = commonest(counted, words)
    entries, scores = log_frequencies(counts, totals, languages, 0.5)
    spread = counted.repartition(shuffle_partitions(docs.sparkSession), "entry")  # a small table is in few files
    counts, totals = commonest(total(spread.mapInArrow(lean(counter(own_grams)), COUNTED)), n_grams)
    pieces, piece_scores = log_frequencies(counts, totals, languages, 0.5)
    by_order = {}
    for order in ORDERS:
        own = [k for k, g in enumerate(pieces) if g[0] == str(order)]
        by_order[order] = table([pieces[k][1:] for k in own], piece_scores[own])
    return Model(languages, table(entries, scores), by_order)


def predicted(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """lang_pred and score of each text, beside the columns to keep. The model's size is bounded by its parameters."""
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = shared.value.predict(batch.column("text"))
            yield pa.record_batch([*(batch.column(i) for i in range(len(keep))), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    arrow_batches(docs.sparkSession)
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(lean(each), schema)
