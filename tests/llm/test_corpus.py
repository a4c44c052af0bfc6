"""Near copies, mixing, the classifier and the pipeline."""

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import jaccard, mixing, quality, seeds
from tidewatch.llm.queries import QUERIES

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_links(rows, percent=85):
    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[doc] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    label = {d: d for d in sets}
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    pairs = defaultdict(int)
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                pairs[a, b] += 1
    linked = [(a, b) for (a, b), n in pairs.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    while True:
        before = dict(label)
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return {d: (len(sets[d]), label[d]) for d in sets}


def components_of(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame).collect()}


def test_components_equal_brute_force(docs, texts):
    assert components_of(docs) == brute_links(texts)


def test_large_regions_and_crowds(docs, texts, monkeypatch):
    """Tiny limits send all through crowds, Voronoi cells and slices."""
    for name, value in (("REGION", 8), ("BLOCK", 4), ("CROWD", 2), ("PIVOTS", 3)):
        monkeypatch.setattr(jaccard, name, value)
    assert components_of(docs) == brute_links(texts)


def test_components_of_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op2_jaccard_join"](spark, folder).collect()}
    assert got == brute_links(rows)


def test_odd_ids_and_empty_table(spark, nothing):
    assert jaccard.join(nothing).count() == 0
    text = " ".join(f"v{i}" for i in range(50))
    frame = spark.createDataFrame([(5, text), (5, text), (5, "other words"), (None, text), (6, text.upper())], "doc_id bigint, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id) for r in jaccard.join(frame).collect())
    assert got == [(-1, 47, 5), (5, 1, 5), (5, 47, 5), (5, 47, 5), (6, 47, 5)]


def test_long_words_of_equal_sums(spark):
    """Thue-Morse words and their complements: different, though sums of powers modulo 2**64 are equal."""
    one = "a"
    while len(one) < 2048:
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, other), (3, f"{one} b c d e"), (4, f"{other} b c d e"), (5, f"{one} " * 9), (6, f"{one} {other} " * 9), (7, one.upper())]
    assert components_of(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute_links(rows)


def test_targets_are_filled_by_weight():
    assert mixing.fill([100, 100, 100], [5, 2, 1], 150, 2) == pytest.approx([93.75, 37.5, 18.75])
    assert mixing.fill([10, 100, 100], [5, 2, 1], 315, 2) == pytest.approx([20, 295 * 2 / 3, 295 / 3])
    assert mixing.fill([10, 10], [5, 1], 40, 2) == [20, 20]
    assert mixing.fill([], [], 0, 2) == [] and mixing.fill([0, 4], [1, 1], 6, 2) == [0, 6]


@pytest.mark.parametrize("sizes, counts, budget, best", [([5, 7], [3, 3], 19, 19), ([4], [10], 17, 16), ([3, 1000], [1, 1], 999, 3), ([0, 6], [4, 2], 12, 12), ([9], [1], 0, 0)])
def test_fit_comes_near(sizes, counts, budget, best):
    took = mixing.fit(np.array(sizes), np.array(counts), budget)
    assert (took <= counts).all() and (took * sizes).sum() == best


def test_mix_of_the_table(spark):
    rows = QUERIES["op8_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    docs["words"] = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in docs.text]
    both = docs.merge(rows, on="doc_id")
    assert len(both) == len(docs) and (both.words == both["size"]).all()
    assert both.taken.isin([0]).sum() + (both.taken == both["size"]).sum() + (both.taken == 2 * both["size"]).sum() >= len(both)
    by = both.groupby("source").agg(size=("size", "sum"), told=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (by["size"] == by.told).all() and (abs(by.target - by.taken) <= 2).all()
    assert by.target.sum() == pytest.approx(1.5 * by["size"].sum())
    again = QUERIES["op8_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    assert rows.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))


def test_mix_of_odd_rows(spark, nothing):
    rows = [(1, None, 4, "a"), (2, None, 4, "b"), (3, "x", 0, "c"), (4, "x", 4, "d"), (4, "x", 4, "d"), (None, "é", 4, "e")]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, target string")
    got = mixing.mix(frame).collect()
    assert len(got) == 6 and sum(r.size * r.copies for r in got) in range(26, 33)
    assert mixing.mix(nothing.withColumn("size", F.lit(1).cast("bigint"))).count() == 0


def test_classifier_on_rows_it_has_not_seen(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    model = quality.train(docs, labels.filter(~held), rows=1500, pool=800)
    told = quality.score(docs.join(labels.filter(held).select("doc_id", "quality"), "doc_id"), model).toPandas()
    good, bad = told[told.quality == 1], told[told.quality == 0]
    assert good.keep.mean() > 0.99 and bad.keep.mean() < 0.05


def test_classifier_cases(spark, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id bigint, quality int")
    docs = spark.createDataFrame([(1, None, None), (2, "", 3), (None, "x" * 100000, 4)], "doc_id bigint, text string, keep int")
    assert [r.keep for r in quality.classify(docs, labels).collect()] == [True] * 3
    known = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    texts = spark.createDataFrame([(i, ("good words here " if i % 2 else "BAD!! BAD!! ") * (i + 1), "en") for i in range(40)] + [(90, None, None), (91, "", "en")], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.keep for r in quality.classify(texts, known).collect()}
    assert len(got) == 42 and all(got[i] == bool(i % 2) for i in range(40))
    assert quality.classify(nothing, known).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave."""
    from tidewatch.session import settle

    folder = "/root/testdata/sf0.001"
    frames = [spark.read.parquet(f"{folder}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(settle(stage(spark, frames[-1], folder)))
    return frames


def test_pipeline_stages(spark, stages):
    start, good, lined, alone, mixed, coded = (f.toPandas() for f in stages)
    assert all(list(f.columns) == list(start.columns) for f in (good, lined, alone, mixed))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").toPandas()
    clean = set(labels[labels.quality == 1].doc_id) & set(start.doc_id)
    # a hundred labels to learn from
    assert len(clean & set(good.doc_id)) >= 0.97 * len(clean)
    assert set(lined.doc_id) <= set(good.doc_id) and (lined.n_chars == lined.text.str.len()).all()
    want = brute_links(list(zip(lined.doc_id, lined.text)))
    assert set(alone.doc_id) == {d for d, (_, c) in want.items() if c == d}
    assert set(mixed.doc_id) <= set(alone.doc_id) and mixed.doc_id.value_counts().max() <= 2
    assert sorted(coded.doc_id) == sorted(mixed.doc_id)


def test_one_of_each_group_keeps_what_is_near_nothing(spark):
    """Unlinked texts with no id or one id all stay, rows without words too; a group is one row, null ids last."""
    text = {c: " ".join(f"{c}{i}" for i in range(40)) for c in "abcdefg"}
    rows = [(None, text["a"]), (None, text["b"]), (None, text["c"]), (7, text["d"]), (7, text["e"]), (None, text["f"]), (2, text["f"].upper()),
            (9, text["f"]), (None, text["g"]), (None, text["g"]), (None, text["g"].upper()), (None, None), (None, ""), (None, " "), (5, None), (5, None)]
    frame = spark.createDataFrame([(d, t, "en", "a", len(t or "")) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.one_of_each_group(spark, frame, "").collect()]
    worded = [(d, t) for d, t in kept if (t or "").strip()]
    assert sorted((d or 0, t.lower()) for d, t in worded) == sorted([(0, text["a"]), (0, text["b"]), (0, text["c"]), (7, text["d"]), (7, text["e"]), (2, text["f"]), (0, text["g"])])
    assert sorted(map(str, (r for r in kept if r not in worded))) == sorted(map(str, [(None, None), (None, ""), (None, " "), (5, None), (5, None)]))


def test_stages_take_an_empty_table(spark, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, "/root/testdata/sf0.001").count() == 0


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "one two", "en", "a", 7), (3, "one two", "en", "a", 7), (None, "x " * 5000, "en", None, 10000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("tag", F.lit("mine"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() > 0


def test_rows_without_an_id_are_ranked_apart(spark):
    """All rows of one size and no id: they spread over the bins, the sum is met and reruns take the same rows."""
    docs = spark.createDataFrame([(None, "a", 3, f"t{i}") for i in range(2000)] + [(1, "b", 3, f"u{i}") for i in range(6000)], "doc_id bigint, source string, size bigint, text string")
    first = mixing.mix(docs, share=0.5)
    taken = {r.source: (r.words, r.target) for r in first.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("words"), F.first("target").alias("target")).collect()}
    assert all(abs(words - target) < 3 for words, target in taken.values())
    keep = lambda df: sorted((r.text, r.copies) for r in df.select("text", "copies").collect())
    assert keep(first) == keep(mixing.mix(docs.repartition(7, "text"), share=0.5))
    ranked = [p for p in first._jdf.queryExecution().optimizedPlan().toString().split("\n") if "xxhash64(8, " in p]
    assert ranked and all("text" in p for p in ranked)


def test_only_rows_that_can_be_near_are_shuffled_with_their_text(spark, monkeypatch):
    words = [f"w{i}" for i in range(5000)]
    rows = [(i, " ".join(words[(i * 7919 + k * k * (i + 1)) % 5000] for k in range(60))) for i in range(600)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(12)] + [(None, rows[3][1]), (5, rows[4][1]), (5, None)]
    plain, sent = seeds.on_key, []
    monkeypatch.setattr(seeds, "on_key", lambda left, right, how: sent.append(left.count()) or plain(left, right, how))
    got = jaccard.join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows) and 24 <= sent[0] < len(rows) / 2
    near = {r.doc_id: r.component_id for r in got if r.doc_id is None or r.doc_id >= 1000}
    assert near == {None: 3, **{1000 + i: i for i in range(12)}}


def test_sifting_keeps_every_wanted_row(spark, monkeypatch):
    rows = spark.range(20000).select(F.when(F.col("id") > 9, F.col("id")).alias("doc_id"), (F.col("id") % 3).alias("tag"), F.lit("t").alias("text"))
    keys = rows.filter("doc_id % 20 = 0 OR doc_id IS NULL").select("doc_id", "tag").distinct()
    left = seeds.sifted(rows, keys, ["doc_id", "tag"])
    assert left.columns == rows.columns and left.filter("doc_id % 20 = 0 OR doc_id IS NULL").count() == 1009
    assert left.count() < 20000 / 4
    assert seeds.sifted(rows, keys.limit(0), ["doc_id", "tag"]).count() == 0
    monkeypatch.setattr(seeds, "SIFTED", 10)
    assert seeds.sifted(rows, keys, ["doc_id", "tag"]).count() == 20000


def test_candidates_that_are_no_links_make_no_regions(spark, monkeypatch):
    """Rows of one family share nearly half their shingles: candidates, but far from linked. Their texts stay where they are."""
    words = [f"w{i}" for i in range(90000)]
    rows = []
    for family in range(40):
        common = words[family * 2000 : family * 2000 + 300]
        rows += [(family * 10 + k, " ".join(common + words[family * 2000 + 400 + k * 150 : family * 2000 + 550 + k * 150])) for k in range(5)]
    rows += [(5000 + i, rows[i][1] + " more") for i in range(6)]
    plain, sent = jaccard._small_regions, []
    monkeypatch.setattr(jaccard, "_small_regions", lambda texts, *rest: sent.append(texts.count()) or plain(texts, *rest))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_links(rows)
    assert 12 <= sent[0] < 30


def test_parities_rule_out_no_link(spark):
    """Pairs on either side of 85 %, of sets whose numbers of classes are the same, or one twice or four times the other."""
    rng = np.random.default_rng(5)
    sets = []
    for n in (1, 2, 40, 60, 64, 65, 70, 120, 128, 130, 500, 1100):
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for change in (0, 1, n // 20, n // 13, n // 12, n // 9, n // 6, n // 2):
            fresh = rng.integers(0, 1 << 63, change, dtype=np.uint64)
            sets += [np.unique(np.append(base[change // 2 :], fresh)), np.unique(np.append(base, fresh))]
    sets = [s for s in sets if len(s)]
    frame = spark.createDataFrame([(k, len(s), jaccard.parity(s).tolist()) for k, s in enumerate(sets)], "id bigint, n bigint, parity array<bigint>")
    pairs = [(a, b) for a in range(len(sets)) for b in range(a)]
    near = spark.createDataFrame(pairs, "a bigint, b bigint")
    size = {k: len(s) for k, s in enumerate(sets)}
    common = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a, b in pairs}
    for percent in (85, 30):
        left = {(r.a, r.b) for r in jaccard._possible(near, frame, percent).collect()}
        linked = {p for p in pairs if 100 * common[p] >= percent * (size[p[0]] + size[p[1]] - common[p])}
        assert linked <= left
        uneven = sum(max(size[a], size[b]) > 2 * min(size[a], size[b]) for a, b in pairs)
        assert len(left) < len(linked) + uneven + (len(pairs) - uneven) / (4 if percent == 85 else 1)


@pytest.mark.parametrize("parts", [1, 2, 9])
def test_pivots_crowded_in_one_batch_are_crowded_in_all(spark, monkeypatch, parts):
    """Copies and near copies of one text: most in one partition, some alone in others."""
    monkeypatch.setattr(jaccard, "CROWD", 3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[: 60 + i % 9] + [f"x{i % 13}"])) for i in range(60)] + [(100 + i, " ".join(words[3 * i : 3 * i + 40])) for i in range(40)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, None), (203, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    many, few = frame.filter("doc_id % 7 > 0").coalesce(1), frame.filter("doc_id % 7 = 0").repartition(parts)
    assert components_of(many.unionByName(few)) == brute_links(rows)


def test_first_pivots_are_shuffled_once(spark, docs):
    signatures = jaccard._signatures(seeds.keyed(docs), 4, 85).localCheckpoint()
    settled = []
    try:
        plain, jaccard.settle = jaccard.settle, lambda df: settled.append(df) or df
        assert jaccard._first_places(signatures).count() > 0
    finally:
        jaccard.settle = plain
    plan = settled[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1, plan


def test_sifting_lets_few_others_through(spark):
    rows = spark.range(40000).select(F.col("id").alias("doc_id"), F.lit(0).alias("tag"), F.lit("t").alias("text"))
    keys = rows.filter("doc_id % 10 = 0").select("doc_id", "tag")
    assert 4000 <= seeds.sifted(rows, keys, ["doc_id", "tag"]).count() < 4000 + 36000 / 30
