"""What a task holds at once: steps over a batch send their rows on in small runs."""

import ctypes
import os
import random
import re
import subprocess
import sys
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tidewatch.llm import bpe, divergence, jaccard, quality
from tidewatch.llm.queries import RANKS, pattern, vocabulary


class Frame:
    """Stands in for a DataFrame and keeps the function that Spark would run on its batches."""

    def __init__(self, **kinds):
        self.schema = T.StructType([T.StructField(c, k) for c, k in kinds.items()])
        self.columns = list(kinds)

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        self.run = run
        return self

    groupBy = agg = select

    groupBy = agg = select


@pytest.fixture(scope="module")
def batch():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(4000)]
    texts = [None, ""] + [" ".join(rng.choices(words, k=rng.randrange(1, 800))) for _ in range(3500)] + ["", None]
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array(texts), pa.array(["en"] * n), pa.array([f"s{i % 3}" for i in range(n)]), pa.array([len(t or "") for t in texts], pa.int64())],
        names=["doc_id", "text", "lang", "source", "n_chars"],
    )


def taken(run, batch):
    """The batches that come out, and the most bytes that were held at once on the way."""
    list(run(iter([batch.slice(0, 5)])))  # what is loaded once does not count
    tracemalloc.start()
    out, most = [], 0
    for found in run(iter([batch])):
        most, _ = max(most, tracemalloc.get_traced_memory()[1]), out.append(found)
        # what was sent on does not count for the next step either
        tracemalloc.reset_peak()
    tracemalloc.stop()
    return out, most


def plain(model):
    return quality.Logistic(np.zeros(model), np.ones(model), np.linspace(-1, 1, model), 0.1)


def test_scores_go_on_in_small_runs(batch):
    model = quality.CoTrained(plain(quality.BINS), plain(quality.LAYOUT + 2 * quality.HASHED), 0.2)
    frame = Frame(doc_id=T.LongType(), text=T.StringType(), lang=T.StringType(), source=T.StringType(), n_chars=T.LongType())
    quality.score(frame, model)
    out, most = taken(frame.run, batch)
    assert max(b.nbytes for b in out) < 2 * quality.PIECE and most < 3 * batch.nbytes
    got = pa.Table.from_batches(out)
    assert got.select(batch.schema.names).to_pylist() == batch.to_pylist()
    alone = pa.Table.from_batches([b for k in (0, 1, 2, 1700, 3502, 3503) for b in frame.run(iter([batch.slice(k, 1)]))])
    assert alone["quality_score"].to_numpy() == pytest.approx(got.take([0, 1, 2, 1700, 3502, 3503])["quality_score"].to_numpy())


def test_ids_go_on_in_small_runs(batch):
    frame = Frame(doc_id=T.LongType(), text=T.StringType())
    bpe.digests(frame, vocabulary(RANKS), pattern(), with_ids=True)
    out, most = taken(frame.run, batch.select(["doc_id", "text"]))
    assert max(b.nbytes for b in out) < 8 * bpe.PIECE and most < 8 * batch.nbytes
    got = pa.Table.from_batches(out).to_pylist()
    assert [r["doc_id"] for r in got] == list(range(len(batch)))
    alone = [r for k in (0, 1, 2, 1700, 3502, 3503) for b in frame.run(iter([batch.slice(k, 1)])) for r in b.to_pylist()]
    assert alone == [got[r["doc_id"]] for r in alone]
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_terms_are_counted_in_small_runs(spark, batch):
    frame = Frame(lang=T.StringType(), source=T.StringType(), text=T.StringType())
    divergence.term_counts(frame)
    names = ["lang", "source", "text"]
    out, most = taken(frame.run, batch.select(names))
    assert len(out) > 3 and most < 8 * batch.nbytes
    got, plain = Counter(), Counter()
    for r in pa.Table.from_batches(out).to_pylist():
        got[r["source"], r["term"]] += r["n"]
    for r in batch.to_pylist():
        plain.update((r["source"], t) for t in (r["text"] or "").split())
    assert got == plain


def anonymous() -> float:
    """MB of this process that no file stands for."""
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def kept_by(stage: str, path: str) -> float:
    """MB that a worker still holds after a task over batches from a stream, beyond what it held after a few rows."""
    frame = Frame(**{"doc_id": T.LongType(), **({"tag": T.LongType()} if stage == "jaccard" else {}), "text": T.StringType()})
    if stage == "jaccard":
        jaccard._signatures(frame, jaccard.SHINGLE, jaccard.PERCENT)
    else:
        bpe.digests(frame, vocabulary(RANKS), pattern(), with_ids=True)

    def batches():
        # through Python's files, as workers read theirs
        with open(path, "rb") as stream:
            for found in pa.ipc.open_stream(stream):
                yield found.select(frame.columns)

    for _ in frame.run(b.slice(0, 5) for b in batches()):
        pass
    ctypes.CDLL(None).malloc_trim(0)
    before = anonymous()
    for _ in frame.run(batches()):
        pass
    return anonymous() - before


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists() or not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="memory can't be read or trimmed here")
@pytest.mark.parametrize("stage", ["jaccard", "bpe"])
def test_workers_give_memory_back(tmp_path, stage):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(4000)]
    path = str(tmp_path / "batches")
    with pa.OSFile(path, "wb") as out:
        writer = None
        for n in (4000, 2000, 4000, 2000):
            texts = [None] + [" ".join(rng.choices(words, k=rng.randrange(1, 1000))) for _ in range(n)]
            made = pa.RecordBatch.from_arrays([pa.array(range(n + 1), pa.int64()), pa.array([0] * (n + 1), pa.int64()), pa.array(texts)], names=["doc_id", "tag", "text"])
            writer = writer or pa.ipc.new_stream(out, made.schema)
            writer.write_batch(made)
        writer.close()
    here = Path(__file__).parent
    env = os.environ | {"PYTHONPATH": os.pathsep.join([str(here.parents[1]), str(here), os.environ.get("PYTHONPATH", "")])}
    # a process of its own, whose memory no other test has touched
    done = subprocess.run([sys.executable, "-c", f"import test_memory as t; print(t.kept_by({stage!r}, {path!r}))"], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < 30
