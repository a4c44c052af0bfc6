"""Exact removal of repeated byte strings with a sparse suffix array over the corpus.

Suffixes begin at the anchors of windows that may repeat. Splitters sampled by
Spark's range partitioning deal them out by their leading bytes; a bucket sorts
its windows by multikey quicksort, eight bytes to a character, and neighbours in
that order that agree over the whole length are repeats. Runs of suffixes that a
bucket boundary cuts, or that are too long for one task, are compared across
buckets by two independent 64-bit hashes of their windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import seeds, textscan
from tidewatch.llm.seeds import ByteWindows
from tidewatch.llm.tables import parts
from tidewatch.session import settle

CHUNK_BYTES = 1 << 20
RUN_ROWS = 4096
_OTHER = np.random.default_rng(20240102).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_SUFFIX = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("begin", pa.int64()), ("at", pa.int32()),
                     ("body", pa.binary()), ("many", pa.bool_()), ("spans", pa.binary())])
_SUFFIX_SQL = "doc_id bigint, tag bigint, begin bigint, at int, body binary, many boolean, spans binary"
_FOUND = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("spans", pa.binary()), ("start", pa.int64()),
                    ("h1", pa.int64()), ("h2", pa.int64()), ("many", pa.bool_())])
_FOUND_SQL = "doc_id bigint, tag bigint, spans binary, start bigint, h1 bigint, h2 bigint, many boolean"


def multikey(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Group number of each start whose next ``length`` bytes occur at another start too, else -1.

    Each level splits the groups by their next eight bytes; what stands alone
    is done. The last character overlaps the one before when ``length`` is no
    multiple of eight.
    """
    result = np.full(len(starts), -1, np.int64)
    if len(starts) < 2:
        return result
    chars = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view(">u8").ravel().astype(np.uint64)
    alive, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for depth in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        char = chars[starts[alive] + depth]
        order = np.lexsort((char, group))
        alive, group, char = alive[order], group[order], char[order]
        new = np.ones(len(alive), bool)
        new[1:] = (group[1:] != group[:-1]) | (char[1:] != char[:-1])
        single = new & np.append(new[1:], True)
        group = np.cumsum(new)
        alive, group = alive[~single], group[~single]
        if not len(alive):
            return result
    result[alive] = group
    return result


def _suffixes(docs: DataFrame, windows: ByteWindows) -> DataFrame:
    """One row per distinct stretch of a batch; stretches that a batch repeats are spans at once."""
    size = windows.window

    def run(batches):
        for batch in batches:
            data, offsets = textscan.column_bytes(batch.column(2))
            kept = []
            for found in windows.scan(data, offsets):
                use = seeds.is_wanted(found, batch.column(3))
                kept.append(np.stack([found.row[use], found.at[use], found.begin[use], found.end[use], found.full[use].view(np.int64)]))
            if not kept:
                continue
            row, at, begin, end, full = np.concatenate(kept, axis=1)
            _, first, back, count = np.unique(full, return_index=True, return_inverse=True, return_counts=True)
            ids, tags, raw = batch.column(0), batch.column(1), data.tobytes()
            again = count[back] > 1
            out = {"doc_id": [], "tag": [], "begin": [], "at": [], "body": [], "many": [], "spans": []}
            for r, blob in seeds.by_owner(row[again], begin[again], end[again] + size):
                for name, value in zip(out, (ids[r].as_py(), tags[r].as_py(), None, None, None, None, blob)):
                    out[name].append(value)
            base = offsets[row[first]]
            lo, hi = base + begin[first], base + end[first] + size
            take = pa.array(row[first])
            out["doc_id"] += ids.take(take).to_pylist()
            out["tag"] += tags.take(take).to_pylist()
            out["begin"] += begin[first].tolist()
            out["at"] += (at[first] - begin[first]).tolist()
            out["body"] += [raw[a:b] for a, b in zip(lo.tolist(), hi.tolist())]
            out["many"] += (count > 1).tolist()
            out["spans"] += [None] * len(first)
            yield pa.RecordBatch.from_pydict(out, schema=_SUFFIX)

    return docs.mapInArrow(run, _SUFFIX_SQL)


def _windows_of(bodies: list[bytes], size: int):
    """``data, starts, owner, offset`` of all windows of the bodies."""
    lens = np.fromiter(map(len, bodies), np.int64, len(bodies))
    offsets = np.append(0, np.cumsum(lens))
    counts = lens - size + 1
    owner = np.repeat(np.arange(len(bodies)), counts)
    offset = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.frombuffer(b"".join(bodies), np.uint8), offsets[owner] + offset, owner, offset


def _spans(rows: list[tuple], owner: np.ndarray, start: np.ndarray, size: int) -> pa.RecordBatch | None:
    """Windows of ``rows`` as united spans of their documents."""
    if not len(owner):
        return None
    found = [(rows[o][0], rows[o][1], blob) for o, blob in seeds.by_owner(owner, start, start + size)]
    return pa.RecordBatch.from_pylist([{"doc_id": d, "tag": t, "spans": s} for d, t, s in found], schema=_FOUND)


def _equal_bodies(rows: list[tuple]):
    """Of stretches with the same bytes one, with a mark; the others and it are repeats as a whole."""
    first: dict[bytes, int] = {}
    again = []
    for k, row in enumerate(rows):
        if (lead := first.setdefault(row[3], k)) != k:
            again += [k, lead]
    marked = set(again)
    kept = [(*rows[k][:4], rows[k][4] or k in marked) for k in first.values()]
    owner = np.array(sorted(marked), np.int64)
    begin = np.array([rows[k][2] for k in owner], np.int64)
    length = np.array([len(rows[k][3]) for k in owner], np.int64)
    blobs = [(rows[o][0], rows[o][1], np.array([a, a + n], "<i8").tobytes()) for o, a, n in zip(owner, begin, length)]
    done = pa.RecordBatch.from_pylist([{"doc_id": d, "tag": t, "spans": s} for d, t, s in blobs], schema=_FOUND) if blobs else None
    return kept, done


def _in_bucket(rows: list[tuple], size: int, pass_on: bool):
    """Spans of the windows that stretches of whole runs repeat; with ``pass_on``, hashes of the distinct windows too."""
    if len(rows) < 2 and not pass_on:
        return
    data, starts, owner, offset = _windows_of([r[3] for r in rows], size)
    begin = np.fromiter((r[2] for r in rows), np.int64, len(rows))[owner] + offset
    h1 = textscan.gram_hash(textscan.byte_sums(data), size)[starts]
    _, back, count = np.unique(h1, return_inverse=True, return_counts=True)
    likely = np.flatnonzero(count[back] > 1)
    group = np.full(len(starts), -1, np.int64)
    group[likely] = multikey(data, starts[likely], size)
    same = np.flatnonzero(group >= 0)
    if (done := _spans(rows, owner[same], begin[same], size)) is not None:
        yield done
    if not pass_on:
        return
    # one of equal windows goes on, as a repeat already
    lone = np.flatnonzero(group < 0)
    some = np.append(lone, same[np.unique(group[same], return_index=True)[1]])
    many = np.fromiter((r[4] for r in rows), bool, len(rows))[owner] | (group >= 0)
    h2 = textscan.gram_hash(textscan.prefix(_OTHER[data]), size)[starts]
    ids, tags = (np.array([r[k] for r in rows], object) for k in (0, 1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids[owner[some]], pa.int64()), pa.array(tags[owner[some]], pa.int64()), pa.nulls(len(some), pa.binary()),
         pa.array(begin[some]), pa.array(h1[some].view(np.int64)), pa.array(h2[some].view(np.int64)), pa.array(many[some])],
        schema=_FOUND,
    )


def _buckets(suffixes: DataFrame, windows: ByteWindows, n: int) -> DataFrame:
    size, gram = windows.window, windows.gram

    def run(batches):
        runs, now, lead, held, opened = [], [], None, 0, False

        def close(last: bool):
            """A run is whole only if neither the bucket's begin nor its end cuts it."""
            nonlocal runs, held, opened, now
            cut = last or not opened or len(now) > RUN_ROWS
            for k in range(0, len(now), RUN_ROWS):
                kept, done = _equal_bodies(now[k : k + RUN_ROWS])
                if done is not None:
                    yield done
                if cut:
                    yield from _in_bucket(kept, size, True)
                elif len(kept) > 1:
                    runs += kept
                    held += sum(len(r[3]) for r in kept)
            opened, now = True, []
            if last or held > CHUNK_BYTES:
                yield from _in_bucket(runs, size, False)
                runs, held = [], 0

        for batch in batches:
            names = ("doc_id", "tag", "begin", "body", "many", "at")
            for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
                head = row[3][row[5] : row[5] + gram]
                if head != lead:
                    if now:
                        yield from close(False)
                    lead = head
                now.append(row[:5])
        yield from close(True)

    suffix = F.expr("substring(body, at + 1)")
    dealt = suffixes.withColumn("suffix", suffix).repartitionByRange(n, "suffix", "doc_id", "begin").sortWithinPartitions("suffix")
    return dealt.drop("suffix").mapInArrow(run, _FOUND_SQL)


def repeated_spans(docs: DataFrame, windows: ByteWindows = ByteWindows()) -> DataFrame:
    """``doc_id, tag, spans`` of ``seeds.keyed`` documents: all bytes under a window that starts elsewhere too."""
    size = windows.window
    suffixes = settle(_suffixes(seeds.with_repeated_grams(docs, windows), windows))
    found = settle(_buckets(suffixes.filter("body IS NOT NULL"), windows, parts(docs.sparkSession)))
    cut = found.filter("spans IS NULL")
    twice = cut.groupBy("h1", "h2").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n")).filter("n > 1")
    start = F.col("start")
    # what a bucket has found repeated needs no answer
    loose = cut.filter("NOT many").join(twice.select("h1", "h2"), ["h1", "h2"]).select("doc_id", "tag", _little(start, start + size).alias("spans"))
    whole = suffixes.filter("spans IS NOT NULL").select("doc_id", "tag", "spans")
    return seeds.gathered(whole.unionByName(found.filter("spans IS NOT NULL").select("doc_id", "tag", "spans")).unionByName(loose))


def _little(start, stop):
    """Two 64-bit integers as 16 little-endian bytes."""
    swap = [F.concat(*(F.substring(F.lpad(F.hex(x), 16, "0"), k, 2) for k in range(15, 0, -2))) for x in (start, stop)]
    return F.unhex(F.concat(*swap))


def dedup(docs: DataFrame, windows: ByteWindows = ByteWindows()) -> DataFrame:
    """Remove every byte under a repeated window.

    Takes ``doc_id, text``; further columns are not read. A null text counts as
    empty and gives zero bytes; texts shorter than a window stay whole. Rows that
    repeat id and text are documents of their own: each repeats the other.
    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes left).
    """
    source = seeds.keyed(docs)
    together = seeds.on_key(source, repeated_spans(source, windows), "left")

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            data, offsets = textscan.column_bytes(batch.column(2))
            raw = memoryview(data.tobytes())
            out["doc_id"] = batch.column(0)
            for r, blobs in enumerate(batch.column(3).to_pylist()):
                text = raw[offsets[r] : offsets[r + 1]]
                starts, stops = seeds.spans_of(blobs)
                kept = b"".join(text[a:b] for a, b in zip(np.append(0, stops), np.append(starts, len(text))))
                for name, value in zip(list(out)[1:], (len(text), len(text) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept)):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_DONE)

    return together.select("doc_id", "tag", "text", "spans").mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")


_DONE = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                   ("kept_sha256", pa.string()), ("kept", pa.binary())])
