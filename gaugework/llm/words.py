"""Words of whole texts as exact codes, their digests, and texts put together again from the words that are kept."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from gaugework.llm.common import mix

_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(code of each word, the different words): equal codes are equal bytes, without any digest."""
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=places[1:])
    step = np.zeros(len(data) + 1, np.int8)
    step[starts] += 1
    step[ends] -= 1
    raw = data[np.cumsum(step[:-1], dtype=np.int8) > 0]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(raw)])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def word_digests(words: pa.Array) -> np.ndarray:
    """128-bit digests of different words, as two columns of 64 bits."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(w) for w in words.to_pylist()]), np.uint64).reshape(-1, 2)


def chained(digest: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Digest of a sequence one word longer; every step mixes all bits, so sequences meet by chance only."""
    return mix((digest ^ value) * _STEP + value)


def joined(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> pa.Array:
    """Text of each document: its kept words with one space between them."""
    starts, ends = starts[kept], ends[kept]
    doc = np.searchsorted(offsets, starts, "right") - 1
    follows = np.zeros(len(starts), bool)
    follows[:-1] = doc[1:] == doc[:-1]
    step = np.zeros(len(data) + 2, np.int32)
    step[starts] += 1
    step[ends + follows] -= 1
    inside = np.cumsum(step[: len(data)]) > 0
    spaced = data.copy()
    spaced[ends[follows]] = 32
    places = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=places[1:])
    raw = spaced[inside]
    buffers = [None, pa.py_buffer(places[offsets]), pa.py_buffer(raw)]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, buffers[1], buffers[2])
