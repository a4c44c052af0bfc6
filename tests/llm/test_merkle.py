"""The manifest against a plain recursive tree, its proofs and the order of its log."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tidewatch.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, source, lang, n, text):
    shown = [None if v is None else str(v) for v in (doc, source, lang, n, text)]
    return digest(*["-" if v is None else f"{len(v.encode())}:{v}" for v in shown])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def climb(tree, i):
    """Per level ``sibling or None, whether it stands to the left``."""
    return [(row[i >> h ^ 1] if (i >> h ^ 1) < len(row) else None, (i >> h) & 1) for h, row in enumerate(tree[:-1])]


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[lang] = levels([leaf(*r) for r in by[lang]])
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, r in enumerate(by[lang]):
            path = climb(trees[lang], i) + climb(top, k)
            shown = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                shown[3] += 1
            node = leaf(*shown)
            for other, left in path:
                node = digest(node) if other is None else digest(other, node) if left else digest(node, other)
            root = top[-1][0]
            out.append((r[0], leaf(*r), trees[lang][-1][0], root, digest(*[o for o, _ in path if o]), node, node == root))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def got(frame):
    return ordered(tuple(r) for r in frame.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(13)
    rows = [(i, rng.choice(["a", "é", None]), rng.choice(["en", "en", "de", None]), rng.choice([None, i, 2**63 - 1]), "x" * (i % 9) + "日") for i in range(150)]
    rows += [(1000 + i, "s", f"l{i:02}", 1, None) for i in range(21)]  # languages of one row
    rows += [(7, "again", "en", 3, "other text"), (None, "s", "en", 1, "no id"), (None, "s", "en", 1, "no id"), (None, None, None, None, None)]
    return rows + [(55, "copy", "en", 5, "copy")] * 40 + [(56, "long", "fr", 5, "word " * 100_000)]


@pytest.mark.parametrize("page", [1, 2, 10])
def test_equals_a_plain_tree(spark, corpus, page):
    found = got(merkle.report(spark.createDataFrame(corpus, SCHEMA).repartition(5), page))
    assert found == ordered(brute(corpus))
    assert {r[-1] for r in found} == {True, False}


def test_positions_are_those_of_a_postorder_walk():
    for n in range(1, 70):
        walk = []

        def visit(level, i):
            if level:
                for child in (2 * i, 2 * i + 1):
                    if child << (level - 1) < n:
                        visit(level - 1, child)
            walk.append((level, i))

        visit(merkle.height(n), 0)
        assert [int(merkle.position(h, i, n)) for h, i in walk] == list(range(len(walk)))


def test_the_log_holds_every_node_once_in_its_place(spark):
    digests = [hashlib.sha256(bytes([i])).digest() for i in range(37)]
    rows = [(0, i, 37, d) for i, d in enumerate(digests)] + [(1, 0, 1, digests[0])]
    trees = merkle.build(spark.createDataFrame(rows, "tree bigint, idx bigint, n bigint, digest binary"), page=2)
    log = {(r.tree, r.pos): bytes(r.digest).hex() for r in trees.log.collect()}
    plain = levels([d.hex() for d in digests])
    want = {(0, int(merkle.position(h, i, 37))): x for h, row in enumerate(plain) for i, x in enumerate(row)}
    assert log == want | {(1, 0): digests[0].hex()} and trees.log.count() == len(log) and trees.rounds == 3
    assert {r.tree: bytes(r.root).hex() for r in trees.roots.collect()} == {0: plain[-1][0], 1: digests[0].hex()}
    for path in trees.log.inputFiles()[:1]:  # rows of a page are written as they complete
        import pyarrow.parquet as pq

        table = pq.read_table(path.removeprefix("file://")).to_pandas()
        for _, rows in table.groupby(["tree", "page"], sort=False):
            assert (np.diff(rows["pos"]) > 0).all()


def test_one_row_and_no_row(spark, nothing):
    row = (5, "s", "en", 1, "t")
    assert got(merkle.report(spark.createDataFrame([row], SCHEMA))) == brute([row])
    empty = merkle.report(nothing)
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_clashing_columns(spark):
    rows = [(i, "s", "en", i, "t") for i in range(9)]
    frame = spark.createDataFrame([(*r, 1, 2, 3, "4") for r in rows], SCHEMA + ", tree int, idx int, n int, leaf string")
    assert got(merkle.report(frame)) == ordered(brute(rows))
