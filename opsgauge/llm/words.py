"""Words of UTF-8 texts as 64-bit hashes, a block of texts at a time.

A word is a run of bytes outside space, tab, newline, vertical tab, form feed and carriage return,
with A-Z lower-cased; those bytes occur in no multi-byte character. The hash of a word is the sum
over its bytes of a random 64-bit number for (place in the word, byte); places from 64 on reuse
the numbers times a power of an odd constant. Two different words have equal hashes with a
probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PLACES = 64
_random = np.random.Generator(np.random.PCG64(20240607))
TABLE = _random.integers(0, 2**64, size=(PLACES, 256), dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)
SHINGLE = _random.integers(0, 2**63, size=16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BLOCK = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(buffer: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of one buffer of bytes. ``between`` says of each byte
    whether it separates words."""
    word = ~between[buffer]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.flatnonzero(word)
    place = np.arange(len(at)) - np.repeat(np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    value = TABLE[place & (PLACES - 1), LOWER[buffer[at]]]
    if lengths.max() > PLACES:
        far = place >= PLACES
        value[far] *= powers(place[far] // PLACES)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return starts, ends, mix(np.add.reduceat(value, first))


def powers(exponents: np.ndarray) -> np.ndarray:
    """Powers of STEP modulo 2**64."""
    out = np.ones(len(exponents), np.uint64)
    base, rest = STEP, exponents.copy()
    with np.errstate(over="ignore"):
        while rest.any():
            out[rest & 1 == 1] *= base
            base = base * base
            rest >>= 1
    return out


def text_blocks(texts: pa.Array, between: np.ndarray = SPACE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of about a quarter of a megabyte of whole texts: the first row, the hashes of their words in order,
    and where each text's words begin among them (one entry more than texts). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        begin, end = offsets[row], offsets[stop]
        # a separator before each text keeps words of neighbouring texts apart
        own = offsets[row : stop + 1] - begin
        buffer = np.full(end - begin + stop - row, 32, np.uint8)
        place = np.arange(end - begin) + np.repeat(np.arange(1, stop - row + 1), np.diff(own))
        buffer[place] = data[begin:end]
        starts, _, hashes = hash_words(buffer, between)
        bounds = np.searchsorted(starts, own + np.arange(stop - row + 1))
        yield row, hashes, bounds
        row = stop


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of that many words, in order; the whole sequence where it is shorter."""
    if not len(words):
        return words
    size = min(width, len(words))
    count = len(words) - size + 1
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total += words[k : k + count] * SHINGLE[k]
    # a whole short sequence must not equal a run of the full width
    return mix(total + np.uint64(size))
