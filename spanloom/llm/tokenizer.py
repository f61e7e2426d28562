"""Token ids of a whole corpus by a public byte-level vocabulary (problem 6).

Texts are cut into pre-tokens; the distinct pre-tokens of a batch are looked up together. A
minimal perfect hash over the vocabulary's byte strings answers those that are tokens by
themselves; the others are merged bottom up, the next pair taken from a heap over a linked list
of parts.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files lie; the folder holds a module with the pre-token pattern.
TOKENIZERS = os.environ.get("SPANLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k"
#: Fixed value: the published pattern of pre-tokens of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text handled at once, and merged pre-tokens remembered by a worker.
CHUNK_BYTES = 1 << 20
REMEMBERED = 200_000
#: Longest pre-token that is remembered.
REMEMBERED_BYTES = 64

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _level_hash(h: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h ^ np.uint64(level * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * _ODD
        x ^= x >> np.uint64(29)
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


def key_hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


@dataclass
class PerfectHash:
    """Minimal perfect hash: levels of bit arrays in which each key is alone at its place."""

    bits: list[np.ndarray] = field(default_factory=list)
    base: list[np.ndarray] = field(default_factory=list)  # ranks of the set bits, by level

    @classmethod
    def of(cls, hashes: np.ndarray, gamma: float = 1.5) -> PerfectHash:
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("keys repeat")
        out, left, done = cls(), hashes, 0
        while len(left):
            level, size = len(out.bits), max(4, int(gamma * len(left)))
            at = _level_hash(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            out.bits.append(alone)
            out.base.append(np.cumsum(alone) - 1 + done)
            done += int(alone.sum())
            left = left[~alone[at]]
        return out

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The key's number 0..n-1; for what is no key any number or -1."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, (bits, base) in enumerate(zip(self.bits, self.base, strict=True)):
            at = _level_hash(hashes[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = base[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token: of all neighbouring parts the pair of least rank, leftmost first, is merged until none is left."""
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that begins at i
    prev, nxt, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue  # one of the two has been merged since
        alive[j], end[i], nxt[i] = False, stop, nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
            k = nxt[j]
            if (r := ranks.get(piece[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        if prev[i] >= 0 and (r := ranks.get(piece[prev[i] : stop])) is not None:
            heapq.heappush(heap, (r, prev[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = nxt[i]
    return out


class Encoder:
    """Ids of texts; one per worker process."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = list(self.ranks)
        hashes = key_hashes(tokens)
        self.hash = PerfectHash.of(hashes)
        slots = self.hash.slots(hashes)
        self.token = np.empty(len(tokens), object)
        self.token[slots] = tokens
        self.id = np.empty(len(tokens), np.int32)
        self.id[slots] = list(self.ranks.values())
        self.find = regex.compile(PATTERN).findall
        self.merged: dict[str, list[int]] = {}

    def _merged(self, text: str, raw: bytes) -> list[int]:
        ids = self.merged.get(text)
        if ids is None:
            ids = merge(raw, self.ranks)
            if len(raw) <= REMEMBERED_BYTES:
                if len(self.merged) >= REMEMBERED:
                    self.merged.clear()
                self.merged[text] = ids
        return ids

    def lookup(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens laid end to end, and the number of each."""
        raw = [p.encode() for p in pieces]
        slots = self.hash.slots(key_hashes(raw))
        tokens = self.token[slots]
        known = np.fromiter((s >= 0 and t == r for s, t, r in zip(slots.tolist(), tokens, raw, strict=True)), bool, len(raw))
        counts = np.ones(len(raw), np.int64)
        misses = np.flatnonzero(~known).tolist()
        found = [self._merged(pieces[i], raw[i]) for i in misses]
        counts[misses] = [len(x) for x in found]
        begin = np.cumsum(counts) - counts
        ids = np.zeros(int(counts.sum()), np.int32)
        ids[begin[known]] = self.id[slots[known]]
        if misses:
            many = counts[misses]
            at = np.repeat(begin[misses], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            ids[at] = np.concatenate([np.asarray(x, np.int32) for x in found])
        return ids, counts

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Codes of the words of all texts, their number by text, and the distinct ones.

        A word begins at a blank before anything but white space. No pre-token goes over such a
        blank, whatever stands before it, so words can be split by themselves.
        """
        lists = [t.split(" ") if no_loose_blank(t) is None else LOOSE.split(t) for t in texts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        nul = any("\0" in t for t in texts)
        firsts, heads = distinct_of([x[0] for x in lists], nul)
        codes, words = distinct_of([w for x in lists for w in x], nul)
        at = np.cumsum(sizes) - sizes
        distinct = [" " + w for w in words]
        codes[at] = firsts + len(distinct)  # a text's first word has no blank before it
        return codes, sizes, distinct + heads

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words end to end, and the number of each."""
        lists = [self.find(w) for w in words]
        codes, pieces = distinct_of([p for x in lists for p in x], any("\0" in w for w in words))
        ids, counts = gather(*self.lookup(pieces), codes)
        return ids, sums(counts, np.fromiter(map(len, lists), np.int64, len(lists)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of each text."""
        codes, sizes, words = self._words(texts)
        ids, counts = gather(*self._word_ids(words), codes)
        return ids, sums(counts, sizes)

    def count(self, texts: list[str]) -> np.ndarray:
        codes, sizes, words = self._words(texts)
        return sums(self._word_ids(words)[1][codes], sizes)


#: A blank that white space or the end follows, and one that doesn't count as loose.
no_loose_blank = re.compile(r" (?!\S)").search
LOOSE = re.compile(r" (?=\S)")


def distinct_of(values: list[str], nul: bool) -> tuple[np.ndarray, list[str]]:
    """Codes of values and the distinct values they stand for."""
    if nul:  # the hash table of strings would end them there
        number: dict[str, int] = {}
        return np.fromiter((number.setdefault(v, len(number)) for v in values), np.int64, len(values)), list(number)
    out = np.empty(len(values), object)
    out[:] = values
    codes, distinct = pd.factorize(out)
    return codes, list(distinct)


def gather(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ids that codes name, end to end, and their lengths."""
    begin, many = (np.cumsum(counts) - counts)[codes], counts[codes]
    at = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    return ids[at], many


def sums(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of counts over runs of the given sizes."""
    return np.diff(np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(sizes)))])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file, made once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_path(name: str = VOCABULARY, folder: str = TOKENIZERS) -> str:
    return os.path.join(folder, f"{name}.tiktoken")


def text_chunks(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of pieces of a batch of about CHUNK_BYTES; nulls as empty, broken bytes as U+FFFD."""
    column = pc.fill_null(column.cast(pa.binary()), b"")
    edge = np.concatenate(([0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))))
    a, n = 0, len(column)
    while a < n:
        b = max(a + 1, int(np.searchsorted(edge, edge[a] + CHUNK_BYTES, "right")) - 1)
        yield a, [x.decode("utf-8", "replace") for x in column.slice(a, b - a).to_pylist()]
        a = b


def token_ids(documents: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids) of every row of documents; ids without special tokens.

    Text that looks like a special token is plain text. A null or empty text has the empty
    list. Rows keep their number: repeated keys give repeated rows, a null key stays null. An
    empty table gives an empty one; further columns are left out. Texts may have any length;
    a pre-token of n bytes takes n log n steps.
    """
    path = path or vocabulary_path()
    kind = documents.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for a, texts in text_chunks(batch[1]):
                ids, counts = own.encode(texts)
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch[0].slice(a, len(texts)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], names=[key, "ids"])

    return documents.select(key, F.col(text).cast("string")).mapInArrow(encode, f"`{key}` {kind}, ids array<int>")


def token_counts(documents: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """The kept columns of every row of documents and its number of tokens; 0 for null and empty texts."""
    path = path or vocabulary_path()
    wanted = documents.select(*keep, F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema[: len(keep)]) + ", tokens long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            tokens = [own.count(texts) for _, texts in text_chunks(batch[len(keep)])]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(np.concatenate(tokens) if tokens else [], pa.int64())], names=[*keep, "tokens"])

    return wanted.mapInArrow(count, schema)
