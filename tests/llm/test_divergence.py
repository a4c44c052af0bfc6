"""The source audit against plain counting, one pair and term at a time."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tidewatch.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "lang string, source string, text string"


def brute(rows, least=3, top=200):
    counts, held, kept = defaultdict(Counter), defaultdict(Counter), {}
    for lang, source, text in rows:
        words = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(words)
        held[lang or ""].update(set(words))
    out = set()
    for lang in held:
        terms = [t for t, n in held[lang].items() if n >= least]
        groups = {s: c for (l, s), c in counts.items() if l == lang}
        whole = sum(groups.values(), Counter())

        def shares(c):
            size = sum(c[t] for t in terms) + len(terms)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // size for t in terms}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s, c in groups.items():
            parts = {"pair": [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in terms)) for o in groups if o != s],
                     "term": [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in terms if c[t] and p[s][t] > q[t]]}
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, t, v, k + 1) for k, (t, v) in enumerate(found) if part == "pair" or k < top}
    return out


def got(frame):
    rows = [tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    words = ["The", "the", "THE", "İstanbul", "ſ", "naïve", "a", "日本", "\U0001F600x", "K"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(400):
        source = f"s{int(rng.random() ** 3 * 9)}"
        chosen = [rng.choice(words[: 20 + 30 * int(source[1])]) for _ in range(rng.randrange(0, 60))]
        rows.append((rng.choice(["en", "de", None]), source if i % 7 else None, "1 ,".join(chosen) if i % 31 else None))
    rows += [("xx", f"t{i}", f"only{chr(97 + i)}") for i in range(3)] + [("yy", "one", "w w"), ("", "é", "\x00 \x7f")] * 2
    rows += [("en", "s1", "rep eat " * 5000)] * 5
    return rows


def test_equals_plain_counts(spark, corpus):
    assert got(divergence.audit(spark.createDataFrame(corpus, SCHEMA).repartition(5))) == brute(corpus)


def test_languages_without_kept_terms_have_pairs_of_zero(spark, corpus):
    rows = [r for r in got(divergence.audit(spark.createDataFrame(corpus, SCHEMA))) if r[0] == "xx"]
    assert sorted(rows) == [("xx", f"t{i}", "pair", f"t{j}", 0, 1 + [k for k in range(3) if k != i].index(j)) for i in range(3) for j in range(3) if i != j]


def test_tiles_and_word_blocks_do_not_matter(spark, corpus):
    assert got(divergence.audit(spark.createDataFrame(corpus, SCHEMA), top=5, min_docs=2, words=1, in_tile=3)) == brute(corpus, 2, 5)


def test_large_counts_stay_exact(spark):
    """Shares of counts whose product with the scale does not fit in 64 bits."""
    rows = spark.createDataFrame([(10**12 + 1, 3 * 10**12, 7)], "n bigint, size bigint, kinds bigint")
    found = rows.select(divergence._share(rows["n"], rows["size"], rows["kinds"]).alias("p")).first()["p"]
    assert found == 1 + 10**9 * (10**12 + 2) // (3 * 10**12 + 7)


def test_empty_and_extra_columns(spark, nothing, corpus):
    assert divergence.audit(nothing).count() == 0
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in corpus[:150]], SCHEMA + ", n int, term int, id int, place int")
    assert got(divergence.audit(frame)) == brute(corpus[:150])
