"""Token ids of whole texts, from the tokenizers library.

A text's ids are the ids of its pieces in a row, so a piece met before needs no second encoding. Pieces
are cut only where no pre-token can span: at a lone space between two characters that are not white space
(the space opens the next piece), and at a lone line break. Texts with other white space are cut at the
safe places alone; texts with U+0001 or U+0002, our marks, or with a string of the tokenizer's special
tokens, which the library takes for the token itself, not at all. A piece of letters is one pre-token and
goes to the tokenizer's model at once; any other piece goes through the whole tokenizer.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator
from itertools import chain
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept, ranges, utf8

#: Pieces that a worker remembers; beyond, it starts again. About 140 MB.
REMEMBERED = 1_000_000
#: Bytes of text that are encoded at once.
AT_ONCE = 8 << 20
#: Before a piece that no space precedes; alone, an uncut text.
BARE, UNCUT = "\x02", "\x01"
SAFE = re.compile(r"(?<=\S) (?=\S)")
#: White space of one byte besides blank and line break, and the marks; white space of more bytes, by its first.
RARE = np.zeros(256, bool)
RARE[[1, 2, 9, 11, 12, 13, 28, 29, 30, 31]] = True
WIDE = {lead: [c.encode() for c in map(chr, range(128, 0x3001)) if c.isspace() and c.encode()[0] == lead] for lead in (0xC2, 0xE1, 0xE2, 0xE3)}


def crowded(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have white space at an end, next to other white space, or neither blank nor line break; or a mark."""
    out = np.zeros(len(offsets) - 1, bool)
    if not len(data):
        return out
    space = (data == 32) | (data == 10)
    at = [np.flatnonzero(space[1:] & space[:-1]), np.flatnonzero(RARE[data])]
    for lead, spaces in WIDE.items():
        for p in np.flatnonzero(data == lead):
            if any(data[p : p + len(s)].tobytes() == s for s in spaces):
                at.append([p])
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    ends = np.concatenate((offsets[full], offsets[full + 1] - 1))
    at.append(ends[space[ends]])
    out[np.searchsorted(offsets, np.concatenate(at).astype(np.int64), side="right") - 1] = True
    return out


def byte_level() -> dict[int, str]:
    """The characters that byte-level tokenizers write for bytes: printable ones as they are, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Known(dict):
    """Pieces by number; one asked for that is new gets the next number and is noted."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        k = self[piece] = len(self)
        self.new.append(piece)
        return k


class PieceEncoder:
    """Encodes batches of texts with one tokenizer file; keeps the ids of pieces between batches."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        #: The strings that the library looks for before it cuts a text into words.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Whether the tokenizer lower-cases and drops white space; else a space belongs to the word after it.
        self.lowers = "Lowercase" in str(self.tokenizer.normalizer)
        self.letters = byte_level()
        self._forget()

    def _forget(self) -> None:
        self.known = Known()
        self.starts = np.zeros(1 << 16, np.int32)
        self.lengths = np.zeros(1 << 16, np.int32)
        self.flat = np.zeros(1 << 18, np.int32)
        self.used = 0

    def _put(self, numbers: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        if (most := len(self.known)) > len(self.starts):
            self.starts, self.lengths = (np.concatenate((x, np.zeros(most, np.int32))) for x in (self.starts, self.lengths))
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(self.used // 2 + len(ids), np.int32)))
        self.starts[numbers] = self.used + np.cumsum(lengths) - lengths
        self.lengths[numbers] = lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _text(self, piece: str) -> str:
        """What a piece stands for in the text."""
        if piece == "\n" or piece == "":
            return "" if self.lowers else piece
        if piece[0] in (BARE, UNCUT):
            return piece[1:]
        return piece if self.lowers else " " + piece

    def _learn(self) -> None:
        """Encodes the pieces noted as new. Letters and the punctuation after them are pre-tokens of their own, looked up apart."""
        known, words, texts, stemmed, asked = self.known, [], [], [], 0
        numbers, lengths, ids, model, letters = [], [], [], self.tokenizer.model.tokenize, self.letters
        mark = "" if self.lowers else letters[32]
        while asked < len(known.new):
            p = known.new[asked]
            asked += 1
            if p.isalpha() and is_latin1(p) and (not self.lowers or p.islower()):
                tokens = model(mark + p if p.isascii() else mark + "".join([letters[b] for b in p.encode()]))
                ids += [t.id for t in tokens]
                lengths.append(len(tokens))
                numbers.append(known[p])
            elif (stem := p.rstrip(punctuation)) and len(stem) < len(p) and stem[-1].isalpha() and stem[-1] < "\u0100" and p[0] != UNCUT:
                stemmed.append((known[p], known[stem], known[BARE + p[len(stem) :]]))
            else:
                words.append(known[p])
                texts.append(self._text(p))
        known.new = []
        if texts:
            own = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            numbers += words
            lengths += map(len, own)
            ids += chain.from_iterable(own)
        if numbers:
            self._put(np.array(numbers), np.array(lengths, np.int32), np.array(ids, np.int32))
        if stemmed:
            number, stem, stop = np.array(stemmed).T
            pairs = np.stack((stem, stop), 1).ravel()
            sizes = self.lengths[pairs]
            self._put(number, sizes.reshape(-1, 2).sum(1), self.flat[ranges(self.starts[pairs], sizes)])

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, pieces), np.int32, len(pieces))

    def _cut(self, text: str) -> list[str]:
        """The pieces of a text with crowded white space."""
        if UNCUT in text or BARE in text or any(s in text for s in self.special):
            return [UNCUT + text]
        first, *rest = SAFE.split(text)
        return [BARE + first, *((x if x.isalpha() or self.lowers else UNCUT + " " + x) for x in rest)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has. Null counts as empty."""
        if len(self.known) > self.remembered:
            self._forget()
        texts = pc.fill_null(texts, "")
        data, offsets = utf8(texts)
        odd = crowded(data, offsets)
        for own in self.special:
            odd |= pc.match_substring(texts, own).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        if self.lowers:
            narrow = np.zeros(len(texts), bool)
            narrow[np.searchsorted(offsets, np.flatnonzero(data > 0xC3), side="right") - 1] = True
            plain = pc.utf8_lower(plain) if not narrow.any() else pc.if_else(pa.array(narrow), plain, pc.utf8_lower(plain))
        cut = pc.split_pattern(pc.replace_substring(plain, "\n", " " if self.lowers else f" \n {BARE}"), " ")
        coded = cut.flatten().dictionary_encode()
        found = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        firsts = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
        if not self.lowers:
            found[firsts[:-1]] = self._numbers([BARE + x if x else "" for x in pc.list_element(cut, 0).to_pylist()])
        others = {i: self._numbers(self._cut(texts[i].as_py())) for i in np.flatnonzero(odd)}
        if self.known.new:
            gc.disable()  # many small lists, none in a cycle
            self._learn()
            gc.enable()
        if others:
            parts = [others.get(i, found[a:b]) for i, (a, b) in enumerate(zip(firsts, firsts[1:]))]
            found, firsts = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        lengths = self.lengths[found]
        ids = self.flat[ranges(self.starts[found], lengths)]
        return ids, np.diff(np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))[firsts])


def is_latin1(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def together(batches: Iterator[pa.RecordBatch], column: str = "text", least: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least so many bytes of the column, but for the last."""
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += batch.column(column).nbytes
        if n >= least:
            yield pa.concat_batches(waiting)
            waiting, n = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def encoder(path: str, remembered: int = REMEMBERED) -> PieceEncoder:
    """The worker's encoder of a file; tasks of one worker share what it remembers."""
    return kept(f"encoder {path} {remembered}", lambda: PieceEncoder(path, remembered))


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with end_id after each text."""
    counts = counts.astype(np.int64)
    out = np.full(len(ids) + len(counts), end_id, np.int32)
    starts = np.cumsum(counts + 1) - (counts + 1)
    out[ranges(starts, counts)] = ids
    return out, counts + 1
