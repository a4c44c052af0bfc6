"""A Merkle manifest of a dataset, kept as a log of nodes in postorder.

Every language has a binary tree over its rows, a last tree has the roots of
these. Builders take aligned pages of ``2^PAGE`` nodes, hash their subtrees and
write nodes in the order in which they complete. Where a node stands in its
tree's log follows from the sizes of the subtrees before it (``position``), so
a proof is read from the log by address: nothing is searched, and a page of
the log holds all siblings of the leaves below it for ``PAGE`` levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.layout import attach, number_rows
from tidewatch.session import settle

PAGE = 10
TOP = -1  # the tree over the trees' roots
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOG = "tree bigint, round int, page bigint, pos bigint, digest binary, below bigint, n bigint"
_ABOVE = "tree bigint, page bigint, n bigint, subroot binary, above binary"


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    return (n - 1).bit_length()


def position(level, index, n: int):
    """Where a node stands in the log: after all that its last leaf ``m`` completes below it.

    Before leaf ``m`` comes, the log holds ``floor(m / 2^l)`` nodes of every level ``l``:
    ``2m - popcount(m)`` in all. Then the leaf and its ancestors follow, level by
    level; those of the last leaf complete at the end, with one child or two.
    """
    last = np.minimum((np.asarray(index, np.int64) + 1) << level, n) - 1
    return 2 * last - np.bitwise_count(last).astype(np.int64) + level


def digest(fields: Sequence[Column]) -> Column:
    """The leaf of a row: integers and strings, each with its length in bytes; null is a dash."""
    shown = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown]), 256)


@dataclass
class Trees:
    """Trees as tables: ``log`` (tree, round, page, pos, digest), ``roots`` (tree, n, root). ``rounds``: pages on top of one another."""

    log: DataFrame
    roots: DataFrame
    rounds: int


def _builder(number: int, page: int):
    """Hashes one page of a round: its rows are the page's new nodes in the order of their completion."""
    bottom = number * page

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree, at = key
        pdf = pdf.sort_values("idx")
        n = int(pdf["n"].iloc[0])
        nodes, first = [d.hex() for d in pdf["digest"]], at << page
        places, found, level = [], [], bottom
        if not bottom:
            places.append(position(0, first + np.arange(len(nodes)), n))
            found += nodes
        while level < min(bottom + page, height(n)):
            nodes = [_hash("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
            first, level = first >> 1, level + 1
            places.append(position(level, first + np.arange(len(nodes)), n))
            found += nodes
        pos = np.concatenate(places)
        order = np.argsort(pos)
        out = pd.DataFrame({"tree": tree, "round": number, "page": at, "pos": pos[order], "digest": [bytes.fromhex(found[i]) for i in order], "n": n})
        out["below"] = pd.Series([pd.NA] * len(out), dtype="Int64")
        top = out.index[-1]  # completes last
        out.loc[top, "below"] = at
        if level == bottom + page and level < height(n):  # a leaf of the next round
            out.loc[top, ["round", "page"]] = [number + 1, at >> page]
        return out[["tree", "round", "page", "pos", "digest", "below", "n"]]

    return grow


def build(leaves: DataFrame, page: int = PAGE) -> Trees:
    """Trees of ``leaves``: ``tree, idx`` from 0, ``n`` leaves of the tree, binary ``digest``.

    A round turns every page of the round before into one node and writes what
    it completes; there are as many rounds as the largest tree has multiples of
    ``page`` levels, each with at most ``2^-page`` of the nodes before.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    rounds = max(1, -(-height(max(1, largest)) // page))
    base, logs = leaves, []
    for number in range(rounds):
        paged = base.select("tree", F.shiftright("idx", page).alias("page"), "idx", "n", "digest")
        log = settle(paged.groupBy("tree", "page").applyInPandas(_builder(number, page), _LOG))
        logs.append(log)
        base = log.filter(F.col("below").isNotNull() & (F.col("n") > 1 << page * (number + 1)))
        base = base.select("tree", F.col("below").alias("idx"), "n", "digest")
    # a tree's root is the one page node of the first round in which it has one page
    ends = [
        log.filter((F.col("below") == 0) & (F.col("n") <= 1 << page * (k + 1)) & ((F.col("n") > 1 << page * k) | (k == 0)))
        for k, log in enumerate(logs)
    ]
    whole, roots = logs[0], ends[0]
    for log, end in zip(logs[1:], ends[1:]):
        whole, roots = whole.unionByName(log), roots.unionByName(end)
    return Trees(whole.select("tree", "round", "page", "pos", "digest"), roots.select("tree", "n", F.col("digest").alias("root")), rounds)


def _siblings(log: pd.DataFrame, idx: np.ndarray, bottom: int, page: int, n: int) -> list[list[bytes]]:
    """For nodes of the lowest level of a page: digests of their siblings in it, by level; one per level that has one."""
    log = log.sort_values("pos")
    pos, held = log["pos"].to_numpy(np.int64), log["digest"].to_numpy()
    out = [[] for _ in idx]
    for level in range(bottom, min(bottom + page, height(n))):
        other = (idx >> (level - bottom)) ^ 1
        there = np.flatnonzero((other << level) < n)
        found = np.searchsorted(pos, position(level, other[there], n))
        for k, at in zip(there, found):
            out[k].append(held[at])
    return out


def _paged_log(log: DataFrame, number: int, above: DataFrame) -> DataFrame:
    """The log rows of a round's pages; a row at position -1 tells each page what lies above it."""
    nothing = F.lit(None)
    rows = log.filter(F.col("round") == number).select("tree", "page", "pos", "digest", nothing.cast("bigint").alias("n"), nothing.cast("binary").alias("subroot"))
    head = above.select("tree", "page", F.lit(-1).cast("bigint").alias("pos"), F.col("above").alias("digest"), "n", "subroot")
    return rows.unionByName(head)


def _split(rows: pd.DataFrame):
    """``log rows, bytes above, n, subroot`` of a page."""
    head = rows[rows["pos"] < 0].iloc[0]
    return rows[rows["pos"] >= 0], bytes(head["digest"]), int(head["n"]), bytes(head["subroot"])


def _reader(bottom: int, page: int):
    """Reads from one page of the log what lies above each page below it."""

    def descend(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree, at = key
        log, over, n, subroot = _split(rows)
        count = -(-n >> bottom) if n else 0
        idx = np.arange(at << page, min((at + 1) << page, count), dtype=np.int64)
        parts = _siblings(log, idx, bottom, page, n)
        return pd.DataFrame({"tree": tree, "page": idx, "n": n, "subroot": [subroot] * len(idx), "above": [b"".join(p) + over for p in parts]})

    return descend


def above_pages(trees: Trees, seeds: DataFrame, page: int = PAGE) -> DataFrame:
    """``tree, page, n, subroot, above`` of the pages of leaves: all siblings above a page, 32 bytes each, from below.

    ``seeds`` has one such row per tree, for its top page. From the top round
    down, the siblings of every page come from the page above it.
    """

    def of_round(number: int) -> Column:
        below = F.lit(0 if number == 0 else 1 << page * number)
        return (F.col("n") > below) & (F.col("n") <= F.lit(1 << min(62, page * (number + 1))))

    above = seeds.filter(of_round(trees.rounds - 1))
    for number in range(trees.rounds - 1, 0, -1):
        lower = _paged_log(trees.log, number, above).groupBy("tree", "page").applyInPandas(_reader(number * page, page), _ABOVE)
        above = settle(lower).unionByName(seeds.filter(of_round(number - 1)))
    return above


def _sides(idx: int, n: int) -> list[int | None]:
    """Per level above a leaf: 0 or 1 if its sibling stands to the right or left, None without a sibling."""
    return [(idx >> level) & 1 if (((idx >> level) ^ 1) << level) < n else None for level in range(height(n))]


def fold(leaf: str, siblings: str, sides: Sequence[int | None]) -> str:
    """The root that a leaf and its siblings, hexadecimal and one after another, lead to."""
    at, node = 0, leaf
    for side in sides:
        if side is None:
            node = _hash(node)
            continue
        other, at = siblings[at : at + 64], at + 64
        node = _hash(other + node if side else node + other)
    return node


def proofs(trees: Trees, asked: DataFrame, above: DataFrame, page: int = PAGE) -> DataFrame:
    """``asked`` (``tree, idx, carry, claimed``) with ``leaf, siblings, sides, n, subroot``, siblings from the leaf's up to the last root's.

    ``claimed`` is another digest to fold in place of the leaf, or null. Whatever
    ``carry`` holds is handed on.
    """
    kind = asked.schema["carry"].dataType.simpleString()
    schema = f"tree bigint, idx bigint, carry {kind}, claimed binary, n bigint, leaf binary, siblings binary, subroot binary"

    def extract(key: tuple, rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(wanted):
            return pd.DataFrame({c: [] for c in ("tree", "idx", "carry", "claimed", "n", "leaf", "siblings", "subroot")})
        log, over, n, subroot = _split(rows)
        idx = wanted["idx"].to_numpy(np.int64)
        log = log.sort_values("pos")
        own = np.searchsorted(log["pos"].to_numpy(np.int64), position(0, idx, n))
        parts = _siblings(log, idx, 0, page, n)
        out = wanted[["tree", "idx", "carry", "claimed"]].copy()
        out["n"], out["leaf"] = n, log["digest"].to_numpy()[own]
        out["siblings"], out["subroot"] = [b"".join(p) + over for p in parts], [subroot] * len(out)
        return out

    left = _paged_log(trees.log, 0, above).groupBy("tree", "page")
    right = asked.withColumn("page", F.shiftright("idx", page)).groupBy("tree", "page")
    return left.cogroup(right).applyInPandas(extract, schema)


def manifest(docs: DataFrame, *, key: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS, claimed: Column | None = None, page: int = PAGE):
    """``trees, top, proofs, root``: the log of all trees, that of the last tree, every row's proof, and the root (None without rows).

    Rows of a group stand by ``key``, null first; rows that share a key by leaf, and
    equal rows are as many equal leaves. Null groups are one group, the first.
    ``claimed`` is a leaf someone presents instead, hexadecimal or null. The
    numbers, logs and the proofs of upper rounds are tables in the shared
    folder, written when this is called.
    """
    row = docs.select(
        F.col(group).alias("lang"), F.col(key).alias("carry"), F.unhex(digest([F.col(f) for f in fields])).alias("digest"),
        F.unhex(F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"),
        F.rand(13).alias("_any"),  # equal rows are interchangeable; this keeps a hot one out of a single range
    )
    # texts are read and hashed once; ranges are then sampled and cut over the leaves alone
    placed = number_rows(settle(row), ["lang"], ["carry", "digest", "_any"], n="n")
    placed = settle(placed.select("lang", "carry", "digest", "claimed", (F.col("rn") - 1).alias("idx"), "n"))
    langs = placed.groupBy("lang").agg(F.max("n").alias("n")).withColumn("_all", F.lit(0))
    langs = settle(number_rows(langs, ["_all"], ["lang"], n="trees").select("lang", (F.col("rn") - 1).alias("tree"), F.col("trees").cast("bigint").alias("trees")))
    leaves = settle(attach(placed, langs, ["lang"]).select("tree", "idx", "n", "digest", "carry", "claimed"))
    trees = build(leaves.select("tree", "idx", "n", "digest"), page)
    ranked = trees.roots.join(langs.select("tree", "trees"), "tree")
    upper = settle(ranked.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.col("trees").alias("n"), F.col("root").alias("digest"), F.col("n").alias("own")))
    top = build(upper.select("tree", "idx", "n", "digest"), page)
    end = top.roots.first()
    seed = top.roots.select("tree", F.lit(0).cast("bigint").alias("page"), "n", F.col("root").alias("subroot"), F.lit(b"").alias("above"))
    asked = upper.select("tree", "idx", F.col("own").alias("carry"), F.lit(None).cast("binary").alias("claimed"))
    found = proofs(top, asked, above_pages(top, seed, page), page)
    seeds = settle(found.select(F.col("idx").alias("tree"), F.lit(0).cast("bigint").alias("page"), F.col("carry").alias("n"), F.col("leaf").alias("subroot"), F.col("siblings").alias("above")))
    every = proofs(trees, leaves.select("tree", "idx", "carry", "claimed"), above_pages(trees, seeds, page), page)
    return trees, top, every, (bytes(end["root"]).hex(), int(end["n"])) if end else None


def report(docs: DataFrame, page: int = PAGE) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, after tampering with some rows.

    Where 7 divides the CRC-32 of the decimal ``doc_id``, ``n_chars`` is one more
    than in the manifest; rows without id or ``n_chars`` stay. No rows give no rows.
    """
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    changed = [more if f == "n_chars" else F.col(f) for f in FIELDS]
    hit = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    _, _, every, end = manifest(docs, claimed=F.when(hit, digest(changed)), page=page)
    root, count = end or ("", 0)

    def folded(batches):
        sides_of_top = {}
        for pdf in batches:
            proof, ends = [], []
            for tree, idx, n, leaf, claim, siblings in zip(pdf["tree"], pdf["idx"], pdf["n"], pdf["leaf"], pdf["claimed"], pdf["siblings"]):
                text = siblings.hex()
                if tree not in sides_of_top:
                    sides_of_top = {tree: _sides(int(tree), count)}  # rows of a tree mostly stand together
                proof.append(_hash(text))
                ends.append(fold((leaf if claim is None else claim).hex(), text, _sides(int(idx), int(n)) + sides_of_top[tree]))
            yield pd.DataFrame({
                "doc_id": pdf["carry"], "leaf": [x.hex() for x in pdf["leaf"]], "subroot": [x.hex() for x in pdf["subroot"]], "root": root,
                "proof_sha256": proof, "folded_root": ends, "verified": [e == root for e in ends],
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    return every.mapInPandas(folded, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return " || ".join(_field(n_chars if f == "n_chars" else f) for f in FIELDS)


ORACLE = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, *, xor(4294967295, list_reduce(
    [4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)] || repeat([-1], 8))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) AS crc FROM documents),
h AS (SELECT k, doc_id, lang, sha256({_leaf('n_chars')}) AS leaf,
        sha256({_leaf('(n_chars::HUGEINT + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END)')}) AS shown FROM d),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM h),
t AS (SELECT lang, 0 AS h, i, n, leaf AS x FROM l
      UNION ALL SELECT lang, h + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(x, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY lang, h, i // 2),
r AS (SELECT lang, x, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS h, i, n, x FROM r
      UNION ALL SELECT h + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(x, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY h, i // 2),
th AS (SELECT lang, h, max(n) AS n FROM t WHERE n > 1 GROUP BY ALL), uh AS (SELECT h, max(n) AS n FROM u WHERE n > 1 GROUP BY ALL),
a AS (SELECT l.k, 0 AS part, th.h, (l.i >> th.h) & 1 AS side, t.x FROM l JOIN th ON th.lang IS NOT DISTINCT FROM l.lang
        LEFT JOIN t ON t.lang IS NOT DISTINCT FROM l.lang AND t.h = th.h AND t.i = xor(l.i >> th.h, 1)
      UNION ALL SELECT l.k, 1, uh.h, (r.i >> uh.h) & 1, u.x FROM l JOIN r ON r.lang IS NOT DISTINCT FROM l.lang CROSS JOIN uh
        LEFT JOIN u ON u.h = uh.h AND u.i = xor(r.i >> uh.h, 1)),
s AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY part, h) AS step FROM a),
p AS (SELECT k, sha256(coalesce(string_agg(x, '' ORDER BY step), '')) AS proof FROM l LEFT JOIN s USING (k) GROUP BY k),
f AS (SELECT k, 0 AS step, shown AS x FROM l
      UNION ALL SELECT f.k, s.step, sha256(CASE WHEN s.x IS NULL THEN f.x WHEN s.side = 1 THEN s.x || f.x ELSE f.x || s.x END) FROM f JOIN s ON s.k = f.k AND s.step = f.step + 1),
e AS (SELECT k, arg_max(x, step) AS folded FROM f GROUP BY k)
SELECT l.doc_id, l.leaf, r.x AS subroot, z.x AS root, p.proof AS proof_sha256, e.folded AS folded_root, e.folded = z.x AS verified
FROM l JOIN r ON r.lang IS NOT DISTINCT FROM l.lang JOIN p USING (k) JOIN e USING (k), (SELECT x FROM u WHERE n = 1) z
"""
