"""Substring dedup by relative Lempel-Ziv parsing on words.

The reference of a document is all text before it. Its index has, for every
window of ``window`` words that may repeat, the window's first place in the
corpus; the index lies in blocks, one to a partition, and every document probes
every block with all its windows, by hashes of 95 bits. Windows whose sources run on beside them join
into factors, and a greedy parse takes the longest factor from the left. Windows
that straddle the end of a factor are probed like all others, so a factor that
begins before that end is found too.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import seeds, textscan
from tidewatch.llm.seeds import WordWindows

_PROBES = "doc_id bigint, tag bigint, start int, count int, h1 bigint, h2 int, factors binary"
_PROBE_ARROW = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("h1", pa.int64()),
                          ("h2", pa.int32()), ("factors", pa.binary())])
_OTHER = np.uint64(0xA0761D6478BD642F)


def chain(start: np.ndarray, count: np.ndarray, ref_doc: np.ndarray, ref_start: np.ndarray, size: int) -> np.ndarray:
    """Stretches of ``count`` windows of one document made factors: rows of ``start, length, ref_doc, ref_start``."""
    order = np.argsort(start, kind="stable")
    start, count, ref_doc, ref_start = start[order].astype(np.int64), count[order].astype(np.int64), ref_doc[order], ref_start[order]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != count[:-1]) | (np.diff(ref_doc) != 0) | (np.diff(ref_start) != count[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return np.stack([start[first], start[last] + count[last] - start[first] + size - 1, ref_doc[first], ref_start[first]], 1).astype("<i8")


def greedy(factors: np.ndarray) -> np.ndarray:
    """Of overlapping factors the fewest that cover the same words, the one that reaches furthest each time."""
    if not len(factors):
        return factors
    factors = factors[np.lexsort((factors[:, 1], factors[:, 0]))]
    out, covered, best = [], -1, None
    for row in factors.tolist():
        end = row[0] + row[1]
        if best is not None and row[0] > covered:
            out.append(best)
            covered, best = best[0] + best[1], None
            if row[0] > covered:
                covered = row[0]
        if best is None:
            covered = max(covered, row[0])
        if end > covered and (best is None or end > best[0] + best[1]):
            best = row
    if best is not None:
        out.append(best)
    return np.array(out, "<i8").reshape(-1, 4)


def _first_of_batch(batch: pa.RecordBatch, row, start, count, h1, h2, size: int) -> pa.RecordBatch:
    """Of equal stretches of a batch the earliest goes on; the others are factors of it at once."""
    ids = batch.column(0).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
    tags = batch.column(1).to_numpy(zero_copy_only=False)
    order = np.lexsort((start, tags[row], ids[row], h2, h1))
    row, start, count, h1, h2 = row[order], start[order], count[order], h1[order], h2[order]
    new = np.ones(len(row), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    first = np.flatnonzero(new)
    lead = first[np.cumsum(new) - 1]
    # rows that repeat id and text are one document: the same place in another of them is no earlier one
    same = np.zeros(len(row), bool)
    same[1:] = ~new[1:] & (np.diff(ids[row]) == 0) & (np.diff(tags[row]) == 0) & (np.diff(start) == 0)
    again = np.flatnonzero(~new & ~same)
    again = again[np.argsort(row[again], kind="stable")]
    cuts = np.flatnonzero(np.diff(row[again])) + 1
    owners, factors = [], []
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(again))):
        if b > a:
            own, source = again[a:b], lead[again[a:b]]
            owners.append(row[own[0]])
            factors.append(chain(start[own], count[own], ids[row[source]], start[source], size).tobytes())
    take = pa.array(np.append(np.array(owners, np.int64), row[first]))

    def column(values, kind):
        return pa.concat_arrays([pa.nulls(len(owners), kind), pa.array(values[first], kind)])

    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(take), batch.column(1).take(take), column(start.astype(np.int32), pa.int32()), column(count.astype(np.int32), pa.int32()),
         column(h1.view(np.int64), pa.int64()), column((h2 >> np.uint64(33)).astype(np.int32), pa.int32()),
         pa.concat_arrays([pa.array(factors, pa.binary()), pa.nulls(len(first), pa.binary())])],
        schema=_PROBE_ARROW,
    )


def _probes(docs: DataFrame, windows: WordWindows, pick, single: bool) -> DataFrame:
    """Probes of the stretches that ``pick(seeds, batch)`` wants: each as a whole, or each of its windows (``single``)."""
    size = windows.window

    def run(batches):
        for batch in batches:
            data, offsets = textscan.column_bytes(batch.column(2))
            kept = []
            for i, hashes, o in windows.hashes(data, offsets):
                sums, twos = textscan.prefix(hashes), textscan.prefix(textscan.mixed(hashes ^ _OTHER))
                grams = textscan.gram_hash(sums, windows.gram)
                at, begin, end, row = textscan.anchors(grams, o[:-1], o[1:] - size, windows.width)
                use = pick(seeds.Seeds(row + i, grams[at], at - o[row], begin - o[row], end - o[row], begin), batch)
                begin, end, row = begin[use], end[use], row[use]
                count = end - begin + 1
                if single:
                    begin = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
                    row, end, count = np.repeat(row, count), begin, np.ones(len(begin), np.int64)
                h1, h2 = (textscan.span_hash(x, begin, end + size) for x in (sums, twos))
                kept.append((row + i, begin - o[row], count, h1, h2))
            if kept and sum(len(k[0]) for k in kept):
                yield _first_of_batch(batch, *map(np.concatenate, zip(*kept)), size)

    return docs.mapInArrow(run, _PROBES)


def _starts(found: seeds.Seeds, batch: pa.RecordBatch) -> np.ndarray:
    """Which stretches begin where their row's list says."""
    lists = batch.column(3)
    lens = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    own = np.repeat(np.arange(len(lens)), lens)
    return np.isin((found.row << 40) | found.begin, (own << 40) | flat)


def _split(probes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``here``: factors found in a batch; ``first``: probes that are the earliest of their kind; ``later``: the others, with theirs.

    Batches have sent each kind once, so a kind has no more rows than there are batches. Places of equal ``doc_id, tag,
    start``, in rows that repeat id and text, share a rank, so none of them is a source of another.
    """
    here = probes.filter("factors IS NOT NULL").select("doc_id", "tag", F.col("factors").alias("spans"))
    # plain columns only, or the shuffled rows would hold structs of them as well
    order = Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").asc_nulls_last(), "tag", "start")
    index = probes.filter("factors IS NULL").select(
        "doc_id", "tag", "start", "count", F.first("doc_id").over(order).alias("ref_doc"), F.first("start").over(order).alias("ref_start"),
        F.rank().over(order).alias("place"),
    )
    return here, index.filter("place = 1"), index.filter("place > 1")


def _chained(later: DataFrame, size: int) -> DataFrame:
    hit = F.struct(F.col("start").alias("a"), F.col("count").alias("n"), F.coalesce("ref_doc", F.lit((1 << 63) - 1)).alias("d"), F.col("ref_start").cast("bigint").alias("s"))
    hits = later.groupBy("doc_id", "tag").agg(F.collect_set(hit).alias("hits"))

    def run(batches):
        for batch in batches:
            column = batch.column(2)
            flat = column.flatten()
            columns = [flat.field(k).to_numpy(zero_copy_only=False) for k in range(4)]
            ends = np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))
            blobs = [chain(*(c[a:b] for c in columns), size).tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], names=["doc_id", "tag", "spans"])

    return hits.mapInArrow(run, "doc_id bigint, tag bigint, spans binary")


def factors(docs: DataFrame, windows: WordWindows = WordWindows()) -> DataFrame:
    """``doc_id, tag, spans`` of ``seeds.keyed`` documents; a span blob holds rows of ``chain``.

    Whole stretches are looked up first; most of what repeats is settled by
    them. Windows are looked up one by one only in stretches that are the first of
    their kind, where the earliest place of every window lies.
    """
    size = windows.window
    wanted = seeds.with_repeated_grams(docs, windows)
    here, first, later = _split(_probes(wanted, windows, lambda found, batch: seeds.is_wanted(found, batch.column(3)), False))
    # the count comes along, so that both sides read the same shuffled rows
    begins = first.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "count")).alias("starts"))
    begins = begins.withColumn("starts", F.col("starts.start"))
    alone = _probes(seeds.on_key(docs, begins, "inner"), windows, _starts, True)
    here_too, _, later_too = _split(alone)
    found = here.unionByName(here_too).unionByName(_chained(later, size)).unionByName(_chained(later_too, size))
    return seeds.gathered(found)


def dedup(docs: DataFrame, windows: WordWindows = WordWindows()) -> DataFrame:
    """Remove every word under a window of words that also starts earlier.

    Takes ``doc_id, text``; further columns are not read. Null ids come last,
    rows that share an id are ordered by a hash of their text, null and short
    texts stay whole. Rows that repeat id and text are one document, none of them
    earlier than another: all get the same result, and words that start nowhere
    earlier stay in all of them. Returns ``doc_id, n_words, n_removed, kept_sha256, kept,
    factors``: the words left, and the parse as ``start, length, ref_doc,
    ref_start`` in words.
    """
    source = seeds.keyed(docs)
    together = seeds.on_key(source, factors(source, windows), "left")

    def run(batches):
        for batch in batches:
            data, offsets = textscan.column_bytes(batch.column(2))
            raw = data.tobytes()
            out = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept", "factors")}
            for r, blobs in enumerate(batch.column(3).to_pylist()):
                words = raw[offsets[r] : offsets[r + 1]].split()
                total = len(words)
                parse = greedy(np.frombuffer(b"".join(blobs or []), "<i8").reshape(-1, 4))
                if len(parse):
                    starts, stops = seeds.union(parse[:, 0], parse[:, 0] + parse[:, 1])
                    words = [w for a, b in zip(np.append(0, stops), np.append(starts, total)) for w in words[a:b]]
                kept = b" ".join(words)
                for name, value in zip(out, (total, total - len(words), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8"), parse.tolist())):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **out}, schema=_DONE)

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string, factors array<array<bigint>>"
    return together.select("doc_id", "tag", "text", "spans").mapInArrow(run, schema)


_DONE = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                   ("kept", pa.string()), ("factors", pa.list_(pa.list_(pa.int64())))])
