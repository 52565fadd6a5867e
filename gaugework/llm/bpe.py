"""Token ids of whole texts by a tokenizers file, with the ids of words remembered.

A single space before a visible character always begins a new piece of a byte-level BPE, so a text is the sum of its chunks
between such spaces. A chunk of lines, each of letters and at most one sign behind them, is the sum of its words, signs and
line breaks; any other chunk is encoded as it is. Texts in which the chunks are not sure (a space inside or at the end of
longer white space) and texts with the string of a special token are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash

from gaugework.llm.common import slices
from gaugework.llm.words import word_codes

#: Strings that are remembered, with some 40 bytes each; when there are more, all are forgotten.
CHUNKS = 1_000_000
SLICE = 1 << 20
_SIGNS = b".,;:!?%&*#$"
_MARK = np.zeros(256, bool)
_MARK[[10, *_SIGNS]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_UNSURE = re.compile(r"\s (?:\s|\Z)|<\|")
_VISIBLE = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The sign of each byte in a byte-level vocabulary; the line break stays what it is, to stand between words.
_SIGN_OF = np.arange(256, dtype="<u2")
_SIGN_OF[[b for b in range(256) if b not in _VISIBLE]] = 256 + np.arange(256 - len(_VISIBLE))
_SIGN_OF[10] = 10
_SPACE_SIGN = chr(_SIGN_OF[32])
_encoders: dict[tuple[str, int, int], Encoder] = {}


def _strings(words: pa.Array) -> list[str]:
    return words.cast(pa.large_string()).to_numpy(zero_copy_only=False).tolist()


class Memory:
    """Ids of strings, found by 128-bit digests of the strings in sorted arrays."""

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = self.strings = 0

    def put(self, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(place, number) of the ids of each string, not yet under a digest."""
        return self.put_flat(np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) for x in ids], np.int64) // 4)

    def put_flat(self, new: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for the ids of all strings one behind the other and the number of each string's."""
        if self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(self.used + 2 * len(new), np.uint32)])
        self.flat[self.used : self.used + len(new)] = new
        place = self.used + np.cumsum(size) - size
        self.used += len(new)
        return place, size

    def find(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number) of the ids of each string; the number is -1 for an unknown one."""
        place, size = np.zeros(len(digests), np.int64), np.full(len(digests), -1, np.int64)
        turn = np.argsort(digests[:, 0])  # neighbours are looked up one after the other
        first, second = digests[turn, 0], digests[turn, 1]
        for high, low, at, n in self.runs:
            spot = np.minimum(np.searchsorted(high, first), len(high) - 1)
            hit = (high[spot] == first) & (low[spot] == second)
            place[turn[hit]], size[turn[hit]] = at[spot[hit]], n[spot[hit]]
        return place, size

    def add(self, digests: np.ndarray, place: np.ndarray, size: np.ndarray) -> None:
        """Keeps strings with different digests; runs are merged so that each is over twice as long as the next."""
        if not len(digests):
            return
        self.strings += len(digests)
        run = [digests[:, 0], digests[:, 1], place.astype(np.uint32), size.astype(np.int32)]
        while self.runs and len(self.runs[-1][0]) < 2 * len(run[0]):
            run = [np.concatenate(x) for x in zip(self.runs.pop(), run, strict=True)]
        order = np.argsort(run[0])
        self.runs.append(tuple(x[order] for x in run))


class Encoder:
    """Encodes texts and remembers up to `chunks` different strings.

    With `special_as_text` the strings of special tokens are ordinary text; without, they are the special tokens, as by the
    library's default.
    """

    def __init__(self, path: str, chunks: int = CHUNKS, special_as_text: bool = True, slice_bytes: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        # words that are one piece each need no search for pieces
        self.splitter, self.ready = self.tokenizer.pre_tokenizer, WhitespaceSplit()
        byte_level = "ByteLevel(add_prefix_space=False" in repr(self.splitter) and "use_regex=True" in repr(self.splitter)
        self.byte_level = byte_level and self.tokenizer.normalizer is None
        vocabulary = self.tokenizer.get_vocab()
        self.leads = np.zeros(max(vocabulary.values()) + 1, bool)
        self.leads[[n for name, n in vocabulary.items() if name.startswith(_SPACE_SIGN)]] = True
        self.known: set[str] = set()
        self.line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.marks = self.whole([chr(b) for b in np.flatnonzero(_MARK)])
        self.most, self.slice_bytes = chunks, slice_bytes or SLICE
        self.memory = Memory()

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Without memory: (ids of all texts in turn, number of each text's)."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(ids)), np.uint32), np.array([len(x) for x in ids], np.int64)

    def _one_piece(self, words: str) -> bool:
        """Whether the tokenizer itself takes any of the letters in a row as one piece."""
        new = set(words) - self.known
        if new and len(self.splitter.pre_tokenize_str("".join(sorted(new)))) == 1:
            self.known |= new
            return True
        return not new

    def _lines(self, words: list[str], lead: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of each word's) of words of letters after `lead`: encoded as the lines of one text.

        After a space, words that are one piece each go to the model as such, in the signs of their bytes, and an id that
        begins with the sign of the space begins a word. Others are cut at the line breaks.
        """
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        text = lead + ("\n" + lead).join(words)
        if lead == " " and self.byte_level and self._one_piece("".join(words)):
            signs = _SIGN_OF[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")
            self.tokenizer.pre_tokenizer = self.ready
            try:
                found = self.tokenizer.encode_batch_fast([signs], add_special_tokens=False)[0].ids
            finally:
                self.tokenizer.pre_tokenizer = self.splitter
            ids = np.array(found, np.uint32)
            return ids, np.diff(np.flatnonzero(self.leads[ids]), append=len(ids))
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        between = ids == self.line_break
        ends = np.append(np.flatnonzero(between), len(ids))
        return ids[~between], np.diff(ends, prepend=-1) - 1

    def _places(self, strings: list[str], lead: str, letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """(place, number) of the ids of `lead` and each of the different strings."""
        if not strings:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        digest = xxhash.xxh3_128_digest
        digests = np.frombuffer(b"".join([digest(lead + s) for s in strings]), np.uint64).reshape(-1, 2)
        place, size = self.memory.find(digests)
        new = np.flatnonzero(size < 0)
        unknown = [strings[i] for i in new.tolist()]
        ids, number = self._lines(unknown, lead) if letters else self.whole([lead + s for s in unknown])
        place[new], size[new] = self.memory.put_flat(ids, number)
        self.memory.add(digests[new], place[new], size[new])
        return place, size

    def _unsure(self, data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray) -> np.ndarray:
        """Which texts have to be encoded whole: the pattern is tried where the bytes may fit it."""
        around = data[np.maximum(spaces[:, None] - np.array([1, 2, 3]), 0)]
        wide = (around[:, 1] == 0xC2) | ((around[:, 2] >= 0xE1) & (around[:, 2] <= 0xE3) & (around[:, 1] >= 0x80))
        maybe = spaces[_BLANK[around[:, 0]] | (wide & (around[:, 0] >= 0x80))]
        special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
        out = np.zeros(len(offsets) - 1, bool)
        for doc in np.unique(np.searchsorted(offsets, np.concatenate([maybe, special]), "right") - 1).tolist():
            out[doc] = _UNSURE.search(data[offsets[doc] : offsets[doc + 1]].tobytes().decode()) is not None
        return out

    def _slice(self, data: np.ndarray, offsets: np.ndarray, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        docs = len(offsets) - 1
        spaces = np.flatnonzero(data == 32)
        unsure = self._unsure(data, offsets, spaces) if len(data) else np.zeros(docs, bool)
        # chunks: between spaces; a text without characters has none
        full = np.flatnonzero(np.diff(offsets))
        start = np.sort(np.concatenate([offsets[full], spaces + 1]), kind="stable")
        stop = np.sort(np.concatenate([spaces, offsets[full + 1]]), kind="stable")
        per_doc = np.bincount(np.searchsorted(offsets, spaces, "right") - 1, minlength=docs)[full] + 1
        doc = np.repeat(full, per_doc)
        first = np.zeros(len(start), bool)
        first[np.cumsum(per_doc) - per_doc] = True
        sure = ~unsure[doc]

        # signs and line breaks, each where it may be in a chunk of lines of letters
        mark = np.flatnonzero(_MARK[data])
        in_chunk = np.searchsorted(start, mark, "right") - 1
        line = data[mark] == 10
        head, tail = mark == start[in_chunk], mark + 1 == stop[in_chunk]
        before, after = data[np.maximum(mark - 1, 0)], data[np.minimum(mark + 1, len(data) - 1)]
        fits = ~head & np.where(line, (before != 10) & ~tail & ~_MARK[after], ~_MARK[before] & (tail | (after == 10)))
        plain = sure & (stop > start)
        plain[in_chunk[~fits]] = False
        ends_word = ~_MARK[before]
        here = plain[in_chunk]
        word = np.concatenate([start[plain], mark[line & here] + 1])
        bare = np.concatenate([first[plain], np.ones(int((line & here).sum()), bool)])
        turn = np.argsort(word, kind="stable")
        word, bare = word[turn], bare[turn]
        open_end = plain & ~_MARK[data[np.maximum(stop - 1, 0)]] if len(data) else plain
        word_end = np.sort(np.concatenate([mark[here & ends_word], stop[open_end]]), kind="stable")
        codes, different = word_codes(data, word, word_end)
        names = _strings(different)
        letters = np.fromiter(map(str.isalpha, names), bool, len(names))
        word_chunk = np.searchsorted(start, word, "right") - 1
        plain[word_chunk[~letters[codes]]] = False
        used = plain[word_chunk]
        word, bare, codes = word[used], bare[used], codes[used]
        here = plain[in_chunk]
        mark = mark[here]

        # every different string once: words after a space, words without one, other chunks, whole texts
        kept = self.memory.used
        tables: list[tuple[np.ndarray, np.ndarray]] = []
        events: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # text, order in it, entry of the tables
        entries = 0

        def take(table: tuple[np.ndarray, np.ndarray], of: np.ndarray, at: np.ndarray, entry: np.ndarray) -> None:
            nonlocal entries
            tables.append(table)
            events.append((of, at, entry + entries))
            entries += len(table[0])

        def strings(lead: str, letters: bool, of: np.ndarray, at: np.ndarray, code: np.ndarray, names: list[str]) -> None:
            found, entry = np.unique(code, return_inverse=True)
            take(self._places([names[i] for i in found.tolist()], lead, letters), of, at, entry)

        word_doc = np.searchsorted(offsets, word, "right") - 1
        for lead, some in ((" ", ~bare), ("", bare)):
            strings(lead, True, word_doc[some], 2 * word[some], codes[some], names)
        other = np.flatnonzero(sure & ~plain)
        filled = other[stop[other] > start[other]]
        code, different = word_codes(data, start[filled], stop[filled])
        names = [*_strings(different), ""]
        all_codes = np.full(len(start), len(names) - 1)
        all_codes[filled] = code
        for lead, some in ((" ", other[~first[other]]), ("", other[first[other] & (stop[other] > start[other])])):
            strings(lead, False, doc[some], 2 * start[some], all_codes[some], names)
        remembered = self.memory.used
        whole = np.flatnonzero(unsure)
        texts = [data[offsets[d] : offsets[d + 1]].tobytes().decode() for d in whole.tolist()]
        take(self.memory.put_flat(*self.whole(texts)), whole, 2 * offsets[whole], np.arange(len(whole)))
        take(self.memory.put_flat(*self.marks), np.searchsorted(offsets, mark, "right") - 1, 2 * mark, (np.cumsum(_MARK) - 1)[data[mark]])
        if end is not None:
            every = np.arange(docs)
            take(self.memory.put_flat(np.array([end], np.uint32), np.array([1])), every, 2 * offsets[1:] + 1, np.zeros(docs, np.int64))

        of, at, entry = (np.concatenate(x) for x in zip(*events, strict=True))
        turn = np.argsort(of << 40 | at, kind="stable")
        of, entry = of[turn], entry[turn]
        place, size = (np.concatenate(x) for x in zip(*tables, strict=True))
        place, size = place[entry], size[entry]
        sums = np.concatenate([[0], np.cumsum(size)])
        ids = self.memory.flat[np.repeat(place - sums[:-1], size) + np.arange(sums[-1])]
        self.memory.used = remembered
        if self.memory.strings > self.most or self.memory.used > max(8 * self.most, kept):
            self.memory = Memory()
        return ids, sums[np.searchsorted(of, np.arange(docs + 1))]

    def encode(self, texts: pa.Array, end: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, offsets) of consecutive whole texts, each followed by the id `end`; a null or empty text has no others."""
        for data, offsets in slices(texts, self.slice_bytes):
            yield self._slice(data, offsets, end)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Of each whole text, little-endian unsigned 32-bit."""
        out: list[bytes] = []
        for ids, offsets in self.encode(pa.array(texts, pa.large_string())):
            raw = ids.astype("<u4").tobytes()
            out += [raw[4 * a : 4 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return out


def encoder(path: str, chunks: int = CHUNKS, slice_bytes: int = SLICE) -> Encoder:
    """One for each worker process, file and bounds of its memory, with the library's default for special tokens."""
    key = path, chunks, slice_bytes
    if key not in _encoders:
        _encoders[key] = Encoder(path, chunks, special_as_text=False, slice_bytes=slice_bytes)
    return _encoders[key]
