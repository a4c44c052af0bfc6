"""Byte-level BPE encoding and decoding over vectorised slices and a cache of merged words."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatch.llm import textscan
from tidewatch.llm.pretoken import slices

CACHE_WORDS = 600_000
ENCODER_WORDS = 1 << 18  # of a worker's lasting cache: 600000 take 40 MB more and save a tenth of the time
PIECE = 1 << 18  # bytes that one step of a task encodes and sends on; a step's arrays are many times as large
ROWS = 512  # rows whose text is taken from a batch at once


class WordCache:
    """Ids of slices by hash. ``merge`` encodes a list of slices; full, the cache begins anew.

    ``merge`` returns ids, and where in them each slice's begin and how many they
    are. Slots are found by linear probing from the upper bits of the hash, for
    all slices at once.
    """

    def __init__(self, merge: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]], limit: int = CACHE_WORDS):
        self.merge, self.limit = merge, limit
        self.clear()

    def clear(self) -> None:
        self.size = 0
        self.table, self.keys = np.full(1 << 16, -1, np.int32), np.zeros(1 << 14, np.uint64)
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        self.first, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _room(self, name: str, size: int) -> None:
        old = getattr(self, name)
        if len(old) < size:
            new = np.zeros(max(size, 2 * len(old)), old.dtype)
            new[: len(old)] = old
            setattr(self, name, new)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(65 - len(self.table).bit_length())).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of every key, -1 if it has none."""
        at = self._home(keys)
        slot = self.table[at]
        rest = np.flatnonzero((slot >= 0) & (self.keys[slot] != keys))
        while len(rest):
            at[rest] = (at[rest] + 1) % len(self.table)
            slot[rest] = found = self.table[at[rest]]
            rest = rest[(found >= 0) & (self.keys[found] != keys[rest])]
        return slot

    def _place(self, keys: np.ndarray) -> None:
        """New slots for distinct keys that have none. The table is never more than half full."""
        self._room("keys", self.size + len(keys))
        self.keys[self.size : self.size + len(keys)] = keys
        begin, self.size = self.size, self.size + len(keys)
        if 2 * self.size > len(self.table):
            self.table, begin = np.full(1 << (4 * self.size - 1).bit_length(), -1, np.int32), 0
        slot = np.arange(begin, self.size, dtype=np.int32)
        at = self._home(self.keys[begin : self.size])
        while len(slot):
            free = self.table[at] < 0
            self.table[at[free]] = slot[free]
            left = self.table[at] != slot
            slot, at = slot[left], (at[left] + 1) % len(self.table)

    def encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` of all slices in turn and the number of ids of each slice."""
        if len(starts) < 2:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if self.size > self.limit:
            self.clear()
        keys = textscan.word_hashes(data, starts[:-1], starts[1:])
        slot = self._find(keys)
        new = np.flatnonzero(slot < 0)
        if len(new):
            unique, where, back = np.unique(keys[new], return_index=True, return_inverse=True)
            where = new[where]
            raw, begin, end = data.tobytes(), starts[where].tolist(), starts[where + 1].tolist()
            ids, first, counts = self.merge([raw[a:b] for a, b in zip(begin, end)])
            n = self.size
            self._place(unique)
            self._room("pool", self.used + len(ids))
            self._room("first", self.size)
            self._room("count", self.size)
            self.pool[self.used : self.used + len(ids)] = ids
            self.first[n : self.size] = self.used + first
            self.count[n : self.size] = counts
            self.used += len(ids)
            slot[new] = n + back
        counts = self.count[slot]
        ends = np.cumsum(counts)
        index = np.arange(ends[-1]) + np.repeat(self.first[slot] - (ends - counts), counts)
        return self.pool[index], counts


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids in turn, where each list's begin and how many they are."""
    lens = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter(chain.from_iterable(lists), np.int32, int(lens.sum()))
    return flat, np.cumsum(lens) - lens, lens


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def encoder(ranks_path: str, pattern: str) -> WordCache:
    """Pair merging by rank, a slice at a time, as the public library merges. One cache to a worker."""
    import tiktoken

    ranks = read_ranks(ranks_path)
    one = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece
    return WordCache(lambda words: flattened([one(w) for w in words]), ENCODER_WORDS)


def encode_rows(known: WordCache, data: np.ndarray, offsets: np.ndarray, limit: int = textscan.PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, ids, ends of the rows' ids)`` of runs of rows."""
    for i, j in textscan.groups_of(offsets, limit):
        part = data[offsets[i] : offsets[j]]
        starts, first = slices(part, offsets[i : j + 1] - offsets[i])
        ids, counts = known.encode(part, starts)
        ends = np.append(0, np.cumsum(counts))[first]
        yield i, ids, ends


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids``, an int array of each whole text; null and empty texts give an empty array.

    Every row stays where it is: no shuffle. Other columns are untouched; one that
    is already called as ``ids`` is replaced.
    """
    keep = [c for c in docs.columns if c != ids]
    source = docs.select(*keep)
    schema = T.StructType([*source.schema, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches):
        known = encoder(ranks_path, pattern)
        for batch in batches:
            data, offsets = textscan.column_bytes(batch.column(keep.index(text)))
            pieces = [(part, np.diff(ends)) for _, part, ends in encode_rows(known, data, offsets)]
            flat = np.concatenate([p for p, _ in pieces]) if pieces else np.zeros(0, np.int32)
            lens = np.concatenate([n for _, n in pieces]) if pieces else np.zeros(0, np.int64)
            column = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lens)), pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*keep, ids])

    return source.mapInArrow(textscan.lean(run), schema)


def token_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' bytes in id order, and where each begins."""
    by_id = sorted((rank, token) for token, rank in ranks.items())
    size = by_id[-1][0] + 1 if by_id else 0
    lens = np.zeros(size + 1, np.int64)
    for rank, token in by_id:
        lens[rank + 1] = len(token)
    return np.frombuffer(b"".join(t for _, t in by_id), np.uint8), np.cumsum(lens)


def decode_ids(pool: np.ndarray, begin: np.ndarray, ids: np.ndarray) -> bytes:
    lens = begin[ids + 1] - begin[ids]
    ends = np.cumsum(lens)
    if not len(ends):
        return b""
    return pool[np.arange(ends[-1]) + np.repeat(begin[ids] - (ends - lens), lens)].tobytes()


def decode(tokens: DataFrame, ranks_path: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``tokens`` with ``out``, the bytes that ``ids`` stand for (empty for null)."""
    keep = [c for c in tokens.columns if c != out]
    source = tokens.select(*keep)
    schema = T.StructType([*source.schema, T.StructField(out, T.BinaryType())])

    def run(batches):
        pool, begin = token_bytes(read_ranks(ranks_path))
        for batch in batches:
            column = batch.column(keep.index(ids))
            rows = [b"" if not (x := column[r]).is_valid else decode_ids(pool, begin, x.values.to_numpy(zero_copy_only=False)) for r in range(len(column))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.binary())], names=[*keep, out])

    return source.mapInArrow(textscan.lean(run), schema)


@cache
def shown_tokens(ranks_path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``token_bytes`` of the tokens, and of their ids as decimals with a comma. Once to a worker."""
    pool, begin = token_bytes(read_ranks(ranks_path))
    shown = [str(i).encode() + b"," for i in range(len(begin) - 1)]
    return pool, begin, np.frombuffer(b"".join(shown), np.uint8), np.append(0, np.cumsum([len(x) for x in shown]))


def digests(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: ``key, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``."""
    source = docs.select(key, text)
    kind = source.schema[key].dataType.simpleString()

    def run(batches):
        known, (pool, begin, shown_pool, shown_at) = encoder(ranks_path, pattern), shown_tokens(ranks_path)
        for part in (batch.slice(a, ROWS) for batch in batches for a in range(0, len(batch), ROWS)):
            data, offsets = textscan.column_bytes(part.column(1))
            # a run of rows at a time goes on, so that no task holds the ids of a whole batch
            for i, ids, ends in encode_rows(known, data, offsets, PIECE):
                plain, said = decode_ids(pool, begin, ids), decode_ids(shown_pool, shown_at, ids)
                at = np.append(0, np.cumsum(begin[ids + 1] - begin[ids]))[ends]
                to = np.append(0, np.cumsum(shown_at[ids + 1] - shown_at[ids]))[ends]
                written, decoded = [], []
                for r in range(len(ends) - 1):
                    written.append(hashlib.sha256(said[to[r] : max(to[r], to[r + 1] - 1)]).hexdigest())
                    decoded.append(hashlib.sha256(plain[at[r] : at[r + 1]]).hexdigest())
                columns = [part.column(0).slice(i, len(written)), pa.array(np.diff(ends), pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [key, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    schema = f"{key} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(textscan.lean(run), schema + (", ids array<int>" if with_ids else ""))
