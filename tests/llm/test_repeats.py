"""Exact dedup of bytes, words and lines against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidewatch.llm import jaccard, lines, lz, seeds, suffix, textscan
from tidewatch.llm.queries import ORACLES, QUERIES


def brute_bytes(rows, size=200):
    seen = Counter()
    for _, text in rows:
        raw = (text or "").encode()
        seen.update(raw[i : i + size] for i in range(len(raw) - size + 1))
    out = {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - size + 1):
            if seen[raw[i : i + size]] > 1:
                gone[i : i + size] = True
        gone = gone[: len(raw)]
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(raw) else 0
        out[doc] = (len(raw), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


def brute_words(rows, size=20):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone[i : i + size] = [True] * size
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[doc] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def rows_of(frame, *columns):
    return {r[0]: tuple(r[1:]) for r in frame.select("doc_id", *columns).collect()}


@pytest.mark.parametrize("run_rows", [2, 4096])
def test_bytes_equal_brute_force(docs, texts, monkeypatch, run_rows):
    """Long runs go across buckets by hash; both ways give the same."""
    monkeypatch.setattr(suffix, "RUN_ROWS", run_rows)
    assert rows_of(suffix.dedup(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(texts)


def test_words_equal_brute_force(docs, texts):
    assert rows_of(lz.dedup(docs), "n_words", "n_removed", "kept_sha256") == brute_words(texts)


def test_factors_name_an_earlier_place_with_the_same_words(docs, texts):
    words = {d: (t or "").split() for d, t in texts}
    found = lz.dedup(docs).select("doc_id", "factors").collect()
    assert any(r.factors for r in found)
    for r in found:
        for start, length, ref, at in r.factors:
            assert (ref, at) < (r.doc_id, start) and length >= 20
            assert words[r.doc_id][start : start + length] == words[ref][at : at + length]


def test_bytes_of_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op1_suffix_dedup"](spark, folder), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows)
    assert rows_of(QUERIES["op4_substring_dedup"](spark, folder), "n_words", "n_removed", "kept_sha256") == brute_words(rows)


def test_rows_that_repeat_an_id(spark):
    text = " ".join(f"v{i}" for i in range(60))
    frame = spark.createDataFrame([(1, text), (1, text), (1, "other"), (None, text)], "doc_id bigint, text string")
    assert sorted(r.n_removed for r in suffix.dedup(frame).collect()) == [0, len(text), len(text), len(text)]
    assert sorted(r.n_removed for r in lz.dedup(frame).collect())[-1] == 60


@pytest.mark.parametrize("slices", [1, 8])
def test_rows_that_repeat_id_and_text_keep_it(spark, slices):
    """Neither row is earlier, in one batch and in several; repeats inside and in later documents go as ever."""
    own, twice = " ".join(f"v{i}" for i in range(60)), " ".join(f"u{i}" for i in range(30))
    rows = [(1, own), (3, f"{own} tail"), (1, own), (None, f"{twice} {twice}"), (None, f"{twice} {twice}"), (1, own)]
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), "doc_id bigint, text string")
    got = sorted((r.doc_id or 9, r.n_removed, r.kept) for r in lz.dedup(frame).collect())
    assert got == [(1, 0, own)] * 3 + [(3, 60, "tail")] + [(9, 30, twice)] * 2


def test_empty_table_and_clashing_columns(spark, nothing):
    assert suffix.dedup(nothing).count() == lz.dedup(nothing).count() == lines.dedup(nothing).count() == 0
    odd = spark.createDataFrame([(1, "a\nb", 5, "x")], "doc_id bigint, text string, n_lines int, tag string")
    assert suffix.dedup(odd).count() == lz.dedup(odd).count() == 1
    assert lines.dedup(odd).select("text", "n_lines", "tag").first()[:] == ("a\nb", 2, "x")


def test_multikey_groups_equal_bytes():
    data = np.frombuffer(b"abcabcabcabcabcabcabcxabcabcabcabcabcabcy", np.uint8)
    starts, length = np.arange(len(data) - 12), 13
    starts = starts[starts + length <= len(data)]
    group = suffix.multikey(data, starts, length)
    raw = data.tobytes()
    same = Counter(raw[s : s + length] for s in starts)
    for s, g in zip(starts, group):
        assert (g >= 0) == (same[raw[s : s + length]] > 1)


def test_anchors_are_chosen_by_content():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 123, 300, dtype=np.uint8)
    found = []
    for lead in (17, 60):
        data = np.concatenate([rng.integers(97, 123, lead, dtype=np.uint8), shared])
        grams = textscan.gram_hash(textscan.byte_sums(data), 73)
        at, begin, end, _ = textscan.anchors(grams, np.array([0]), np.array([len(data) - 200]), 128)
        # every window has its anchor, inside it
        assert (np.diff(begin) > 0).all() and begin[0] == 0 and end[-1] == len(data) - 200 and (begin[1:] == end[:-1] + 1).all()
        assert ((at >= end) & (at + 73 <= begin + 200)).all()
        found.append({int(a - lead) for a, b in zip(at, begin) if b >= lead})
    assert found[0] == found[1]


def test_lines(spark):
    from check import canonical, connect

    folder = "/root/testdata/sf0.001"
    got = QUERIES["op5_line_dedup"](spark, folder).toPandas()
    assert canonical(got) == canonical(connect(folder).execute(ORACLES["op5_line_dedup"]).df())


def test_line_cases(spark):
    rows = [(1, None), (2, ""), (3, "a\nb\nc\nd"), (4, "new\na\nb\nc\nd"), (4, "new\na\nb\nc\nd"), (None, "a\nb\nc\nd"), (5, "\n" * 3000)]
    got = lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), mean_lines=2).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].text is None and by[1][0].n_lines == 0 and by[2][0].n_lines == 1
    assert by[3][0].lines_removed == 0 and by[None][0].lines_removed > 0
    assert by[4][0] == by[4][1] and by[5][0].n_lines == 3001
    plan = lines.dedup(spark.createDataFrame(rows, "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _alike(spark, bits):
    """Two texts of different words whose hashes end in the same bits."""
    words = F.concat_ws(" ", *[F.concat(F.lit(c), F.col("id").cast("string")) for c in "abcdefgh"])
    each = spark.range(20_000).select(words.alias("text")).withColumn("h", F.xxhash64("text").bitwiseAND(F.lit((1 << bits) - 1)))
    return each.groupBy("h").agg(F.collect_list("text").alias("t")).filter("size(t) > 1").first()["t"][:2]


def test_rows_without_ids_are_told_apart_by_more_than_a_few_bits(spark):
    """Texts that agree in 24 bits of their hash and have nothing else in common."""
    import corpus_pipeline

    one, two = _alike(spark, 24)
    rows = [(None, one, "en", "s", 1), (None, two, "en", "s", 1), (9, one, "en", "s", 1), (9, two, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert sorted(r.text for r in kept.collect()) == sorted([one, two])
    assert sorted((r.doc_id or 0, r.n_shingles) for r in jaccard.join(docs).collect()) == [(0, 5)] * 2 + [(9, 5)] * 2
    tags = {(r.doc_id, r.text): r.tag for r in seeds.tagged(docs.unionByName(docs.limit(0))).collect()}
    assert len(set(tags.values())) == 2 and 0 not in tags.values()
    assert {r.tag for r in seeds.tagged(docs.filter("doc_id = 9").limit(1)).collect()} == {0}


def test_anchors_beyond_the_packed_positions(monkeypatch):
    rng = np.random.default_rng(3)
    grams = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    grams[500:900] = grams[500]
    first, last = np.array([0]), np.array([3000 - 16])
    monkeypatch.setattr(textscan, "POS_BITS", 12)
    packed = textscan.anchors(grams, first, last, 16)
    mask = ~np.uint64((1 << 12) - 1)
    wide = textscan._leftmost_least(grams & mask, 16)
    plain = [i + int(np.argmin((grams & mask)[i : i + 16])) for i in range(3000 - 15)]
    assert wide.tolist() == plain and packed[0].tolist() == sorted(set(plain))
    monkeypatch.setattr(textscan, "POS_BITS", 11)
    assert textscan.anchors(grams, first, last, 16)[0].max() < 3000
