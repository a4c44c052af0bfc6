"""The scan ledger: spans against plain regular expressions on text, and that nothing is scanned twice."""

import hashlib
import random
import re

import pytest

from tidewatch.llm import ledger
from tidewatch.llm.ledger import BASE, RULES, Ledger, Rule

ASSIGN = "({})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)".format(
    "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
)
PLAIN = [("assign", ASSIGN, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)]


def brute(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, g, least) in enumerate(PLAIN) for m in re.finditer(p, text or "") if len(m[g]) >= least]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


TEXTS = [
    None, "", " ", "password=short", "PassWord: 'longenough'", "token=secret= abcdefgh", "secret=token=abcdefgh", "api_key=apikey:12345678",
    "é日本\U0001F600 passwd = \"Zz9+/_.=-x\" é token:aaaaaaaa", "AKIA" + "B" * 12, "AKIA" + "B" * 11, "AKIAAKIA" + "7" * 9, "xAKIA" + "Q" * 40 + "akia",
    "f" * 31, "f" * 32, "g" + "0123456789abcdef" * 3 + "G", "paſſword=abcdefgh", "toKen=abcdefgh", "toKen=abcdefgh", "token\t=abcdefgh",
    "secret=" + "0" * 40, "-----BEGIN RSA PRIVATE KEY-----", "Authorization: Bearer abcdefghijklmnopqrst==", "token token token" + " " * 500 + "=" + "y" * 9,
]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    bits = ["password", "token", "=", ":", " ", "'", "a" * 8, "AKIA", "Z9" * 7, "deadbeef" * 4, "é", "secret", "api", "_", "key", "\n", "x=y"]
    rows = list(enumerate(TEXTS)) + [(100 + i, "".join(rng.choice(bits) for _ in range(rng.randrange(0, 40)))) for i in range(300)]
    rows += [(None, TEXTS[4]), (None, TEXTS[4]), (4, "another version, token=abcdefgh"), (4, TEXTS[4]), (999, "no secret here " * 50_000 + "ab" * 20)]
    return rows + [(2000 + i, "same token=copycopy") for i in range(500)]


def test_equals_plain_expressions(spark, corpus, tmp_path):
    got = ledger.digests(spark.createDataFrame(corpus, "doc_id bigint, text string").repartition(7), str(tmp_path / "l")).collect()
    want = []
    for doc, text in corpus:
        spans = brute(text)
        counts = [sum(s.startswith(kind + ":") for s in spans) for kind, *_ in PLAIN]
        want.append((doc, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    for r in got:  # what the further rules add stands among the base spans
        assert hashlib.sha256(",".join(s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")).encode()).hexdigest() == r.base_sha256
    assert {r.doc_id: r.spans for r in got}[21] == "pem:0:31"
    assert {r.doc_id: r.spans for r in got}[22] == "bearer:15:44"
    scanned = Ledger(spark, str(tmp_path / "l")).scans()
    assert scanned.count() == scanned.select("blob").distinct().count() == len({t or "" for _, t in corpus})


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "l"))
    frame = lambda rows: spark.createDataFrame(rows, "path string, rev int, text string")
    first = [("a", 1, "token=aaaaaaaa"), ("b", 1, "clean"), ("c", 1, "token=aaaaaaaa"), ("d", 1, None)]
    book.update(frame(first), ("path", "rev"), rules=BASE)
    assert book.scans().count() == 3
    # one new text, one moved, one reverted; the old version of "a" stays on record
    book.update(frame([("a", 2, "clean"), ("b", 2, "AKIA" + "C" * 20), ("e", 2, "token=aaaaaaaa")]), ("path", "rev"), rules=BASE)
    assert book.scans().count() == 4
    hits = {(r.path.path, r.path.rev): [f.kind for f in r.found] for r in book.report().collect()}
    assert hits == {("a", 1): ["assign"], ("b", 1): [], ("c", 1): ["assign"], ("d", 1): [], ("a", 2): [], ("b", 2): ["access"], ("e", 2): ["assign"]}
    # a new version of one rule meets every blob of the snapshot once, the other rules none
    changed = (Rule("access", rb"AKIA[A-Z0-9]+", 30, version=2), *(r for r in BASE if r.kind != "access"))
    book.update(frame([(p, 3, t) for p, _, t in first] + [("b", 3, "AKIA" + "C" * 20)]), ("path", "rev"), rules=changed)
    again = book.scans().collect()
    assert len(again) == 8 and sum(r.rules == ["access@2"] for r in again) == 4
    assert [f.kind for r in book.report(rules=changed).collect() if r.path.path == "b" for f in r.found] == []
    # nothing new: nothing scanned
    book.update(frame(first), ("path", "rev"), rules=changed)
    assert book.scans().count() == 8


def test_a_run_that_was_not_committed_does_not_count(spark, tmp_path):
    import pathlib

    book = Ledger(spark, str(tmp_path / "l"))
    docs = spark.createDataFrame([(1, "token=aaaaaaaa")], "doc_id int, text string")
    book.update(docs)
    marks = list(pathlib.Path(tmp_path / "l" / "scans").glob("*/_SUCCESS"))
    assert len(marks) == 1
    marks[0].rename(marks[0].with_name("_gone"))
    assert book.scans().count() == 0
    versions = book.update(docs)
    assert [len(r.found) for r in book.report(versions).collect()] == [1]


def test_empty_table_and_clashing_columns(spark, nothing, tmp_path):
    assert ledger.digests(nothing, str(tmp_path / "a")).count() == 0
    frame = spark.createDataFrame([(1, "token=abcdefgh", 1, 2, 3, 4)], "doc_id bigint, text string, blob int, path int, packed int, todo int")
    assert [r.spans for r in ledger.digests(frame, str(tmp_path / "b")).collect()] == ["assign:0:14"]
    assert all(r.name == f"{r.kind}@1" for r in RULES)
