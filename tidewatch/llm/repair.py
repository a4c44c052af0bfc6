"""Token ids in shards compressed by a grammar of repeated pairs (Re-Pair), with random access.

A shard is one row of a table that Spark writes: the documents of a range of
``doc_id`` in order, their ids as one sequence of symbols. Symbols below
``FIRST_RULE`` are ids; each later one stands for two earlier symbols. A shard
stores its rules, the length to which each rule expands, the symbols, and for
every ``STRIDE`` symbols the position in the ids, so a reader can decode any
stretch without the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import textscan
from tidewatch.llm.bpe import WordCache, encode_rows, flattened
from tidewatch.llm.tables import parts
from tidewatch.session import settle, shared_dir

FIRST_RULE = 1 << 16
ROUNDS = 4
RULES_A_ROUND = 1024
LEAST_COUNT = 8
STRIDE = 1024
SHARD_IDS = 1 << 18
JOINED = 512
_BINS = 1 << 18

SCHEMA = (
    "part int, shard int, first_doc bigint, n_ids bigint, null_docs bigint, doc_ids binary, doc_lens binary, "
    "rules binary, rule_lens binary, symbols binary, marks binary"
)


def _pairs(symbols: np.ndarray) -> np.ndarray:
    return (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:].astype(np.uint64)


def _bins(pairs: np.ndarray) -> np.ndarray:
    return (textscan.mixed(pairs) & np.uint64(_BINS - 1)).astype(np.int64)


def _frequent(pairs: np.ndarray, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent pairs, and for each position the number of its pair among them or -1.

    Bins of a hash are counted first, then exactly what fell into full bins. Of
    two frequent pairs in one bin the more frequent is taken; the other's turn
    is a later round.
    """
    bins = _bins(pairs)
    full = np.bincount(bins, minlength=_BINS)
    # the count that about twice as many bins reach as rules are wanted
    reached = np.cumsum(np.bincount(np.minimum(full, 1 << 12))[::-1])[::-1]
    cut = max(least, int((reached >= 2 * most).sum()) - 1)
    kinds, counts = np.unique(pairs[full[bins] >= cut], return_counts=True)
    order = np.lexsort((kinds, -counts))
    order = order[counts[order] >= least][:most]
    chosen = kinds[order]
    own = _bins(chosen)
    table = np.full(_BINS, -1, np.int64)
    table[own[::-1]] = np.arange(len(own))[::-1]
    used = table[own] == np.arange(len(own))
    chosen, own = chosen[used], own[used]
    table[own] = np.arange(len(own))
    at = table[bins]
    some = np.flatnonzero(at >= 0)
    at[some[chosen[at[some]] != pairs[some]]] = -1
    return chosen, at


def compress(ids: np.ndarray, rounds: int = ROUNDS, a_round: int = RULES_A_ROUND, least: int = LEAST_COUNT):
    """``symbols, rules, lengths``; a round replaces its most frequent pairs, from the left where they overlap."""
    symbols = ids.astype(np.uint32)
    rules, lengths = np.zeros((0, 2), np.uint32), np.zeros(0, np.int64)
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        pairs = _pairs(symbols)
        chosen, at = _frequent(pairs, a_round, least)
        if not len(chosen):
            break
        hit = np.flatnonzero(at >= 0)
        # of a run of overlapping hits every second one is replaced
        begin = np.diff(hit, prepend=-2) > 1
        run = np.maximum.accumulate(np.where(begin, hit, -1))
        hit = hit[(hit - run) % 2 == 0]
        base = FIRST_RULE + len(rules)
        new = np.stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        lengths = np.append(lengths, _lengths(new[:, 0], lengths) + _lengths(new[:, 1], lengths))
        rules = np.concatenate([rules, new])
        symbols[hit] = base + at[hit]
        keep = np.ones(len(symbols), bool)
        keep[hit + 1] = False
        symbols = symbols[keep]
    return symbols, rules, lengths


def _lengths(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.ones(len(symbols), np.int64)
    rule = symbols >= FIRST_RULE
    out[rule] = lengths[symbols[rule] - FIRST_RULE]
    return out


def expand(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """The ids that ``symbols`` stand for."""
    if len(symbols) <= len(rules):
        return _unrolled(symbols, rules)
    # each rule is unrolled once
    lens = np.ones(len(rules), np.int64)
    while (lens != (longer := _lengths(rules[:, 0], lens) + _lengths(rules[:, 1], lens))).any():
        lens = longer
    pool = np.concatenate([np.arange(FIRST_RULE, dtype=np.uint32), _unrolled(np.arange(FIRST_RULE, FIRST_RULE + len(rules), dtype=np.uint32), rules)])
    first = np.append(np.arange(FIRST_RULE), FIRST_RULE + np.cumsum(lens) - lens)
    counts = _lengths(symbols, lens)
    ends = np.cumsum(counts)
    return pool[np.arange(ends[-1]) + np.repeat(first[symbols] - (ends - counts), counts)] if len(symbols) else symbols


def _unrolled(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    while True:
        rule = symbols >= FIRST_RULE
        if not rule.any():
            return symbols
        ends = np.cumsum(1 + rule)
        out = np.zeros(int(ends[-1]), np.uint32)
        plain = ~rule
        out[ends[plain] - 1] = symbols[plain]
        both = rules[symbols[rule] - FIRST_RULE]
        out[ends[rule] - 2], out[ends[rule] - 1] = both[:, 0], both[:, 1]
        symbols = out


def stretch(shard: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``[start, stop)`` of a shard row, decoding only the symbols that cover them."""
    stop = min(stop, shard["n_ids"])
    if stop <= start:
        return np.zeros(0, np.uint32)
    marks = np.frombuffer(shard["marks"], "<i8")
    symbols = np.frombuffer(shard["symbols"], "<u4")
    rules = np.frombuffer(shard["rules"], "<u4").reshape(-1, 2)
    a, b = np.searchsorted(marks, start, "right") - 1, np.searchsorted(marks, stop, "left")
    found = expand(symbols[a * STRIDE : b * STRIDE], rules)
    return found[start - marks[a] : stop - marks[a]]


def pack(part: int, shard: int, doc_ids: list[int | None], lens: list[int], ids: np.ndarray) -> dict:
    """A shard row. Null ids come first in it: ``null_docs`` counts them, and ``doc_ids`` has 0 there."""
    symbols, rules, lengths = compress(ids)
    null_docs = doc_ids.count(None)
    ends = np.cumsum(_lengths(symbols, lengths))
    marks = np.append(0, ends[STRIDE - 1 : len(ends) - 1 : STRIDE]) if len(ends) else np.zeros(1, np.int64)
    return {
        "part": part, "shard": shard, "first_doc": doc_ids[0], "n_ids": len(ids),
        "null_docs": null_docs, "doc_ids": np.array([0] * null_docs + doc_ids[null_docs:], "<i8").tobytes(), "doc_lens": np.array(lens, "<i8").tobytes(),
        "rules": rules.astype("<u4").tobytes(), "rule_lens": lengths.astype("<i8").tobytes(),
        "symbols": symbols.astype("<u4").tobytes(), "marks": marks.astype("<i8").tobytes(),
    }


def unpack(shard: dict) -> np.ndarray:
    return expand(np.frombuffer(shard["symbols"], "<u4"), np.frombuffer(shard["rules"], "<u4").reshape(-1, 2))


@cache
def library_cache(path: str) -> tuple[WordCache, object]:
    """Slices encoded by the tokenizers library; and its tokenizer for whole texts. One of each to a worker."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # a line feed between two slices that are no white space is a slice of its own
    # and changes neither, so many slices go to the library as one text
    feed = tokenizer.encode("\n", add_special_tokens=False).ids

    def merge(words: list[bytes]):
        texts = [w.decode("utf-8") for w in words]
        ids, first, counts, used = [], np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), 0
        row = [k for k, t in enumerate(texts) if not t[-1].isspace()] if len(feed) == 1 else []
        runs = [row[k : k + JOINED] for k in range(0, len(row), JOINED)]
        joined = ["\n".join([texts[i] for i in run]) + "\n" for run in runs]
        done = np.zeros(len(texts), bool)
        for run, e in zip(runs, tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            found = np.array(e.ids, np.int32)
            ends = np.flatnonzero(found == feed[0])
            if len(ends) == len(run):
                begin = np.append(0, ends[:-1] + 1)
                ids.append(found)
                first[run], counts[run], done[run] = used + begin, ends - begin, True
                used += len(found)
        rest = np.flatnonzero(~done)
        alone = flattened([e.ids for e in tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)])
        first[rest], counts[rest] = used + alone[1], alone[2]
        return np.concatenate([*ids, alone[0]]), first, counts

    return WordCache(merge), tokenizer


def encode_batch(known: WordCache, tokenizer, specials: list[bytes], data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Ids of every row. Rows that hold a special token's text go to the library whole."""
    raw = data.tobytes()
    odd = set()
    for special in specials:
        at = raw.find(special)
        while at >= 0:
            odd.add(int(np.searchsorted(offsets, at, "right")) - 1)
            at = raw.find(special, at + 1)
    for i, ids, ends in encode_rows(known, data, offsets):
        for r in range(len(ends) - 1):
            if i + r in odd:
                text = raw[offsets[i + r] : offsets[i + r + 1]].decode("utf-8")
                yield np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
            else:
                yield ids[ends[r] : ends[r + 1]]


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``doc_id, text`` in ascending ``doc_id`` order and write the shards to ``path``.

    Null and empty texts hold only ``end_id``. Null ids come first, in the order
    of a hash of their texts, so that many of them are several ranges. Rows are dealt by sampled ranges
    of ``doc_id``; a range writes a shard whenever ``shard_ids`` ids are full, so
    a task holds one shard however many rows it has.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.when(F.col("doc_id").isNull(), F.xxhash64("text"))]
    ranged = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").repartitionByRange(parts(spark), *order)
    ordered = ranged.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        slices, tokenizer = library_cache(tokenizer_path)
        specials = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        waiting, lens, ids, held, shard, part = [], [], [], 0, 0, 0

        def flush():
            row = pack(part, shard, waiting, lens, np.concatenate(ids))
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            data, offsets = textscan.column_bytes(batch.column(1))
            keys, part = batch.column(0).to_pylist(), batch.column(2)[0].as_py() if len(batch) else part
            for key, found in zip(keys, encode_batch(slices, tokenizer, specials, data, offsets)):
                waiting.append(key)
                lens.append(len(found) + 1)
                ids += [found, np.array([end_id], np.int32)]
                held += len(found) + 1
                if held >= shard_ids:
                    yield flush()
                    waiting, lens, ids, held, shard = [], [], [], 0, shard + 1
        if waiting:
            yield flush()

    ordered.mapInArrow(run, SCHEMA).write.mode("overwrite").parquet(path)


_ARROW = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("first_doc", pa.int64()), ("n_ids", pa.int64()), ("null_docs", pa.int64()),
    *((n, pa.binary()) for n in ("doc_ids", "doc_lens", "rules", "rule_lens", "symbols", "marks")),
])


def read_shards(spark, path: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``.

    A shard's first position is the sum of ``n_ids`` of all before it: sums per
    range first, then within the range, so no task sees more than the counts.
    """
    table = spark.read.schema(SCHEMA).parquet(path)
    sizes = table.select("part", "shard", "n_ids")
    whole = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = whole.select("part", F.coalesce(earlier, F.lit(0)).alias("base"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("part", "shard", F.coalesce(inside, F.lit(0)).alias("inner")).join(base, "part")
    # written, so that its true size decides whether the shards have to move to it
    first = settle(first.select("part", "shard", (F.col("inner") + F.col("base")).alias("base")))
    placed = table.join(first, ["part", "shard"])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row).astype("<u4")
                lens = np.frombuffer(row["doc_lens"], "<i8")
                ends = np.cumsum(lens)
                starts = ends - lens
                nameless = np.arange(len(lens)) < row["null_docs"]
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=nameless), pa.array(starts + row["base"]), pa.array(lens), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    columns = ["n_ids", "null_docs", "doc_ids", "doc_lens", "rules", "symbols", "base"]
    return placed.select(*columns).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write all ``docs`` as shards in the shared folder and report what the files hold."""
    import uuid

    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens/{uuid.uuid4()}"
    write_shards(docs, path, tokenizer_path)
    return read_shards(spark, path)
