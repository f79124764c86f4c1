"""Byte-pair encoding with word ends, and its inverse.

A word's parts are held as two contiguous lists: the parts' ids, and the rank of the merge of each
part with the next. The least rank is sought by a scan, its boundary deleted, and the two ranks
beside it refreshed. Very long words, where repeated scans would take quadratic time, get the same
merges in the same order from a heap over linked parts. Distinct words are merged once while they
stay in a bounded cache.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from opsgauge.llm.workspace import ship_package

BITS = 20
MASK = (1 << BITS) - 1
NO_MERGE = 1 << 62
SHORT = 256
#: Bytes of merged words that a task holds, and what a short one takes besides its characters and ids.
CACHED_BYTES = 40 << 20
ENTRY_BYTES = 300


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it
    is printable in Latin-1 and no blank, else the next unused one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return [out[b] for b in range(256)]


class Words(dict):
    """Word -> its ids as int32 bytes and its tokens joined by a blank, for words met lately. When half
    of ``CACHED_BYTES`` is full, the words not met since the last time are forgotten."""

    def __init__(self, merge):
        super().__init__()
        self.merge, self.older, self.size = merge, {}, 0

    def __missing__(self, word: str) -> tuple[bytes, str]:
        out = self.older.get(word)
        if out is None:
            out = self.merge(word)
        if len(word) <= SHORT:
            self.size += ENTRY_BYTES + 2 * len(word) + len(out[0])
            if self.size > CACHED_BYTES // 2:
                self.older, self.size = dict(self), 0
                self.clear()
            self[word] = out
        return out

    def forget(self) -> None:
        self.clear()
        self.older, self.size = {}, 0


class WordBpe:
    """Encodes and decodes like the vocabulary file's own library, without added special tokens.

    The file must have the parts of the word-level vocabulary: NFC, blanks, lower case; a split by a
    pattern whose matches are kept; byte-level letters; a suffix at word ends; no decoder.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, splits = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        if spec["decoder"] is not None or not splits[0]["invert"] or model["unk_token"] is not None:
            raise ValueError("not a vocabulary of the supported kind")
        vocab = model["vocab"]
        if max(vocab.values()) > MASK:
            raise ValueError("too many tokens")
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"], regex.V1)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + model["end_of_word_suffix"]] for c in letters]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # a merge is its rank and the new id in one number, so the least number is the least rank
        self.merges = {vocab[a] << BITS | vocab[b]: rank << BITS | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        self.words = Words(self._of_word)

    def merge_word(self, data: bytes) -> list[int]:
        """The ids of one word, by the contiguous rank array."""
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        if len(ids) > SHORT:
            return self._merge_long(ids)
        find = self.merges.get
        ranks = [find(a << BITS | b, NO_MERGE) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < NO_MERGE:
            i = ranks.index(least)
            ids[i] = least & MASK
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find(ids[i - 1] << BITS | ids[i], NO_MERGE)
            if i < len(ranks):
                ranks[i] = find(ids[i] << BITS | ids[i + 1], NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for long words: least rank first, leftmost first, by a heap."""
        find = self.merges.get
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(m, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (m := find(a << BITS | b)) is not None]
        heapq.heapify(heap)
        gone = -1
        while heap:
            merge, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = merge & MASK, gone
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y >= 0 and (m := find(ids[x] << BITS | ids[y])) is not None:
                    heapq.heappush(heap, (m, x, ids[x], ids[y]))
        return [x for x in ids if x != gone]

    def _of_word(self, word: str) -> tuple[bytes, str]:
        ids = self.merge_word(word.encode())
        return array("i", ids).tobytes(), self.decode(ids)

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by blanks, special ones included."""
        return " ".join(map(self.tokens.__getitem__, ids))

    def pieces(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not text.isascii():
            # capital sigma has one small form here, wherever it stands
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.pattern.findall(text.lower())

    def encode_text(self, text: str) -> tuple[bytes, str]:
        """All ids of a text as int32 bytes, and the decoded text."""
        if "<|" in text and self.special_pattern.search(text):
            found = []
            for part in self.special_pattern.split(text):
                if part in self.special:
                    found.append((np.int32(self.special[part]).tobytes(), part))
                else:
                    found += map(self.words.__getitem__, self.pieces(part))
        else:
            found = list(map(self.words.__getitem__, self.pieces(text)))
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_text(text)[0], np.int32).tolist()


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """One vocabulary for all tasks of a worker."""
    return WordBpe(path)


SLICE_BYTES = 1 << 22


def encode_column(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All rows and columns, with the ids of ``text`` and the text decoded from them.

    ``path`` is the vocabulary file, at the same place on every machine. A null text is an empty one:
    no ids, an empty decoded text. Columns of the table named like the new ones are replaced.
    """
    ship_package(df.sparkSession)
    df = df.drop(*(c for c in df.columns if c.lower() in (ids.lower(), decoded.lower())))
    schema = T.StructType(
        [*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)

        def encoded(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            found = [bpe.encode_text(x) for x in texts]
            ends = np.cumsum([0, *(len(x[0]) // 4 for x in found)])
            values = np.frombuffer(b"".join([x[0] for x in found]), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            columns = [*batch.columns, lists, pa.array([x[1] for x in found], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, ids, decoded])

        try:
            for batch in batches:
                place, begin, size, texts = batch.schema.get_field_index(text), 0, 0, []
                for n, value in enumerate(batch.column(place)):
                    texts.append(value.as_py() or "")
                    size += len(texts[-1])
                    if size >= SLICE_BYTES:
                        yield encoded(batch.slice(begin, n + 1 - begin), texts)
                        begin, size, texts = n + 1, 0, []
                if texts:
                    yield encoded(batch.slice(begin), texts)
        finally:
            # the worker stays for other tasks, and perhaps for other stages
            bpe.words.forget()

    return df.mapInArrow(encode, schema)
