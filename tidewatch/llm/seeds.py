"""Which stretches of which documents can hold a repeated window at all.

Every window of a fixed length chooses one of its grams by content alone
(``textscan.anchors``). Equal windows choose equal grams, so a window whose gram
occurs once in the corpus is not repeated. Only grams are counted over the
corpus; their rows are a small part of its positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import textscan
from tidewatch.session import settle


# Grams are counted by 48 bits of their hash: two that fall together only let a few more windows through.
_SHORT = np.uint64(16)
SIFTED = 1 << 24


@dataclass
class Seeds:
    """Anchors of a run of rows. ``begin`` and ``end``: first and last window start of each, in its row."""

    row: np.ndarray
    gram: np.ndarray
    at: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    full: np.ndarray


@dataclass(frozen=True)
class ByteWindows:
    """Windows of ``gram + width - 1`` bytes."""

    gram: int = 73
    width: int = 128

    @property
    def window(self) -> int:
        return self.gram + self.width - 1

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[Seeds]:
        for i, part, o, shift in textscan.pieces(data, offsets, self.window):
            sums = textscan.byte_sums(part)
            grams = textscan.gram_hash(sums, self.gram)
            at, begin, end, row = textscan.anchors(grams, o[:-1], o[1:] - self.window, self.width)
            full = textscan.span_hash(sums, begin, end + self.window)
            base = o[row] - shift
            yield Seeds(row + i, grams[at], at - base, begin - base, end - base, full)


@dataclass(frozen=True)
class WordWindows:
    """Windows of ``gram + width - 1`` words."""

    gram: int = 5
    width: int = 16

    @property
    def window(self) -> int:
        return self.gram + self.width - 1

    def hashes(self, data: np.ndarray, offsets: np.ndarray):
        """``first row, word hashes, row bounds in them`` of runs of whole rows."""
        for i, j in textscan.groups_of(offsets):
            part = data[offsets[i] : offsets[j]]
            start, stop, first = textscan.words(part, offsets[i : j + 1] - offsets[i])
            yield i, textscan.word_hashes(part, start, stop), first

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[Seeds]:
        for i, hashes, o in self.hashes(data, offsets):
            sums = textscan.prefix(hashes)
            grams = textscan.gram_hash(sums, self.gram)
            at, begin, end, row = textscan.anchors(grams, o[:-1], o[1:] - self.window, self.width)
            base = o[row]
            yield Seeds(row + i, grams[at], at - base, begin - base, end - base, textscan.span_hash(sums, begin, end + self.window))


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, tag, text``."""
    return tagged(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "tag", "text")


def tagged(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``tag`` that tells rows apart which share a ``doc_id``, or have none, but not a ``text``.

    It is a 64-bit hash of the text where the id is not the row's own, and 0
    elsewhere, so it is never null and costs nothing in shuffles of unique ids.
    The ids that repeat are counted and written when this is called; Spark sends
    them to the rows, or shuffles both, by their true size.
    """
    own = F.col("doc_id").cast("bigint")
    again = settle(docs.groupBy(own.alias("_again")).agg(F.count("*").alias("_n")).filter((F.col("_n") > 1) | F.col("_again").isNull()).select("_again", F.lit(True).alias("_shared")))
    joined = docs.join(again, own.eqNullSafe(F.col("_again")), "left")
    tag = F.when(F.col("_shared"), F.xxhash64(F.col("text"))).otherwise(F.lit(0).cast("bigint"))
    return joined.withColumn("tag", F.coalesce(tag, F.lit(0).cast("bigint"))).select(*docs.columns, "tag")


def on_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by ``doc_id`` (null too) and ``tag``; ``right`` gives its other columns."""
    other = right.withColumnsRenamed({"doc_id": "_doc", "tag": "_tag"})
    same = left["doc_id"].eqNullSafe(other["_doc"]) & (left["tag"] == other["_tag"])
    joined = left.join(other, same, how)
    return joined if how == "left_semi" else joined.drop("_doc", "_tag")


def sifted(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key ``on`` is among ``keys``, and about one in seventy of the others.

    Meant for wide rows before a join that few of them outlive, so that the rest is
    not shuffled. Keys hashed twice are bits of 64-bit words, a byte for each key and
    hash, which are sent to the rows; beyond ``SIFTED`` keys all rows go on. ``keys`` is
    read three times.
    """
    many = keys.count()
    if many > SIFTED:
        return rows
    found = rows
    for probe in range(2):
        at = F.pmod(F.xxhash64(F.lit(probe), *on), F.lit(64 * (many // 8 + 1)))
        word, bit = F.floor(at / 64), F.expr("shiftleft(1L, cast(_at % 64 as int))")
        words = keys.select(at.alias("_at")).groupBy(F.floor(F.col("_at") / 64).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
        found = found.withColumn("_at", at).withColumn("_here", word).join(F.broadcast(words), F.col("_here") == F.col("_word"))
        found = found.filter(F.col("_bits").bitwiseAND(bit) != 0).select(*rows.columns)
    return found


def _grams(docs: DataFrame, windows) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = textscan.column_bytes(batch.column(2))
            for found in windows.scan(data, offsets):
                order = np.lexsort((found.gram, found.row))
                row, gram = found.row[order], found.gram[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
                first = np.flatnonzero(new)
                take = pa.array(row[first])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array((gram[first] >> _SHORT).view(np.int64)),
                     pa.array(np.diff(np.append(first, len(row))), pa.int32())],
                    names=["doc_id", "tag", "gram", "n"],
                )

    return docs.mapInArrow(run, "doc_id bigint, tag bigint, gram bigint, n int")


def with_repeated_grams(docs: DataFrame, windows) -> DataFrame:
    """The ``keyed`` documents that hold grams which occur more than once, with these ``grams``.

    Counts combine on the map side; a gram that a third of all documents share is
    split by adaptive execution in the join back.
    """
    grams = _grams(docs, windows)
    common = grams.groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram")
    wanted = grams.join(common, "gram").groupBy("doc_id", "tag").agg(F.collect_set("gram").alias("grams"))
    return on_key(docs, wanted, "inner")


def is_wanted(found: Seeds, grams: pa.Array) -> np.ndarray:
    """Which anchors have a gram that their row's list names."""
    flat = grams.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    lens = grams.value_lengths().to_numpy(zero_copy_only=False)
    own = np.repeat(np.arange(len(lens), dtype=np.uint64), lens)
    salt = np.uint64(0x9E3779B97F4A7C15)
    return np.isin((found.gram >> _SHORT) ^ textscan.mixed(found.row.astype(np.uint64) * salt), flat ^ textscan.mixed(own * salt))


def union(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching spans made one."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > stops[:-1]
    first = np.flatnonzero(new)
    return starts[first], np.append(stops[first[1:] - 1], stops[-1])


def by_owner(owner: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Per owner its united spans as little-endian pairs of 64-bit integers."""
    order = np.argsort(owner, kind="stable")
    owner, starts, stops = owner[order], starts[order], stops[order]
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(owner))):
        if b > a:
            x, y = union(starts[a:b], stops[a:b])
            yield int(owner[a]), np.stack([x, y], 1).astype("<i8").tobytes()


def spans_of(blobs: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """One document's spans, united, from all its blobs."""
    if not blobs:
        none = np.zeros(0, np.int64)
        return none, none
    pairs = np.frombuffer(b"".join(blobs), "<i8").reshape(-1, 2)
    return union(pairs[:, 0], pairs[:, 1])


def gathered(parts: DataFrame) -> DataFrame:
    """``doc_id, tag, spans``: all span blobs of a document."""
    return parts.groupBy("doc_id", "tag").agg(F.collect_list("spans").alias("spans"))
