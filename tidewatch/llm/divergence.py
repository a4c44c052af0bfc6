"""How the sources of a language differ in their words, from bitsets of terms per group and count.

A term of a language has an id, frequent terms first. For every group (language and
source) and every count that occurs in it, the ids of the terms with that count
are bits of 64-bit words. The joint cells of two groups, how many terms have count
``i`` here and ``j`` there, are the bits set in both words; terms that a group
lacks are the complement of its own words. A pair's divergence is the sum of
its cells, each times what one term of that cell adds, so no pair is ever
compared term by term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.layout import number_rows
from tidewatch.llm import textscan
from tidewatch.session import settle

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
PIECE = 2 << 20  # bytes whose terms a task counts at once; its arrays are many times as large
WORDS = 16  # bitset words of a language that one task compares
TILE = 64  # groups of a language that one task compares with as many others
_ROWS = 512
# Terms are runs of ASCII letters and of everything outside ASCII, whose UTF-8 bytes are 128 and above.
_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


def _terms(part: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased terms of some rows and the row of each."""
    inside = _TERM[part]
    cut = np.zeros(len(part) + 1, bool)
    cut[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1 : len(part)]
    ends[:-1] &= ~inside[1:] | cut[1 : len(part)]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    bounds = np.zeros(len(start) + 1, np.int64)
    np.cumsum(stop - start, out=bounds[1:])
    kept = textscan.lowered(part[inside])
    found = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(bounds), pa.py_buffer(kept))
    return found, np.searchsorted(offsets, start, "right") - 1


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` from ``lang, source, text``: occurrences and documents that hold the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textscan.column_bytes(batch.column(2))
            names = [batch.column(k).dictionary_encode() for k in (0, 1)]
            codes = [x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in names]
            group = codes[0] * max(1, len(names[1].dictionary)) + codes[1]
            for i, j in textscan.groups_of(offsets, PIECE):
                found, row = _terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                if not len(found):
                    continue
                coded = found.dictionary_encode()
                kinds = len(coded.dictionary)
                each, n = np.unique(row * kinds + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
                at = each // kinds + i
                cells, first, back = np.unique(group[at] * kinds + each % kinds, return_index=True, return_inverse=True)
                total = np.zeros(len(cells), np.int64)
                np.add.at(total, back, n)
                rows = pa.array(at[first])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), coded.dictionary.take(pa.array(cells % kinds)).cast(pa.string()),
                     pa.array(total), pa.array(np.bincount(back, minlength=len(cells)).astype(np.int64))],
                    names=["lang", "source", "term", "n", "docs"],
                )

    each = docs.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, size: Column, kinds: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / (size + kinds))`` without rounding: decimals of 38 digits, then whole division."""
    upper = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return (F.call_function("div", upper, (size + kinds).cast("decimal(20,0)")) + 1).cast("bigint")


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def vocabulary(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, total, id``: what at least ``min_docs`` documents of a language hold, by falling total."""
    held = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
    held = held.filter(F.col("docs") >= min_docs).select("lang", "term", "total", (-F.col("total")).alias("_falling"))
    return number_rows(held, ["lang"], ["_falling", "term"], rn="id").select("lang", "term", "total", (F.col("id") - 1).alias("id"))


def bitsets(cells: DataFrame) -> DataFrame:
    """``lang, source, n, word, bits``: bit ``id % 64`` of word ``id / 64`` for each term with count ``n`` in the group."""
    bit = F.expr("shiftleft(1L, cast(id % 64 as int))")
    placed = cells.select("lang", "source", "n", F.floor(F.col("id") / 64).alias("word"), bit.alias("_bit"))
    return placed.groupBy("lang", "source", "n", "word").agg(F.bit_or("_bit").alias("bits"))


def _cells(p: np.ndarray, bits: np.ndarray, place: np.ndarray, q: np.ndarray, others: np.ndarray, other_place: np.ndarray, total: np.ndarray) -> None:
    """Add every joint cell of the rows here with the rows there to ``total[place, other place]``."""
    for i in range(0, len(p), _ROWS):
        joint = np.bitwise_count(bits[i : i + _ROWS, None] & others[None, :])
        a, b = np.nonzero(joint)
        gap = p[i + a] - q[b]
        np.add.at(total, (place[i + a], other_place[b]), gap * gap // q[b] * joint[a, b].astype(np.int64))


def _compare(key, bits: pd.DataFrame, groups: pd.DataFrame, words: int, in_tile: int) -> pd.DataFrame:
    """Of two tiles of groups, over some words, what each ordered pair adds to its divergence."""
    lang, part, first, second = key
    groups = groups.drop_duplicates("place").sort_values("place").reset_index(drop=True)
    places, none = groups["place"].to_numpy(), groups["p_none"].to_numpy()
    kinds = int(groups["kinds"].iloc[0])
    tile = (places - 1) // in_tile
    sides = [np.flatnonzero(tile == first), np.flatnonzero(tile == second)]
    total = np.zeros((len(places), len(places)), np.int64)
    word, have = bits["word"].to_numpy(), bits["bits"].to_numpy().astype(np.int64).view(np.uint64)
    p, at = bits["p"].to_numpy(), np.searchsorted(places, bits["place"].to_numpy())
    for w in range(part * words, min((part + 1) * words, -(-kinds // 64))):
        here = np.flatnonzero(word == w)
        whole = np.uint64((1 << min(64, kinds - 64 * w)) - 1)
        held = np.zeros(len(places), np.uint64)
        np.bitwise_or.at(held, at[here], have[here])
        absent = whole & ~held
        lack = np.flatnonzero(absent)
        rows_p = np.concatenate([p[here], none[lack]])
        rows_bits = np.concatenate([have[here], absent[lack]])
        rows_at = np.concatenate([at[here], lack])
        one, two = (np.isin(rows_at, side) for side in sides)
        x, y = ((rows_p[s], rows_bits[s], rows_at[s]) for s in (one, two))
        _cells(*x, *y, total)
        if first != second:
            _cells(*y, *x, total)
    a, b = (np.concatenate([np.repeat(s, len(t)) for s, t in (sides, sides[::-1])][: 1 + (first != second)]),
            np.concatenate([np.tile(t, len(s)) for s, t in (sides, sides[::-1])][: 1 + (first != second)]))
    a, b = a[a != b], b[a != b]
    names = groups["source"].to_numpy()
    return pd.DataFrame({"lang": lang, "source": names[a], "item": names[b], "value": total[a, b]})


def _tiled(rows: DataFrame, in_tile: int) -> DataFrame:
    """Copies of the rows of a group for each other tile of its language."""
    tile = F.floor((F.col("place") - 1) / in_tile)
    copies = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("groups") - 1) / in_tile))))
    placed = copies.withColumn("first", F.least(tile, "_other")).withColumn("second", F.greatest(tile, "_other")).drop("_other", "groups")
    return placed.select(*[F.col(c).alias(c) for c in placed.columns])  # columns of its own: both sides come from the same groups


def pairs(bits: DataFrame, groups: DataFrame, words: int = WORDS, in_tile: int = TILE) -> DataFrame:
    """``lang, source, item, value``: the divergence of every group from every other of its language."""
    share = _share(F.col("n"), F.col("size"), F.col("kinds"))
    placed = bits.join(groups, ["lang", "source"]).select("lang", "place", "groups", "word", "bits", share.alias("p"))
    left = _tiled(placed.withColumn("part", F.floor(F.col("word") / words)), in_tile)
    none = F.when(F.col("kinds") > 0, _share(F.lit(0).cast("bigint"), F.col("size"), F.greatest("kinds", F.lit(1)))).otherwise(1)
    last = F.greatest(F.ceil(F.col("kinds") / (64 * words)) - 1, F.lit(0).cast("bigint"))
    listed = groups.withColumn("p_none", none).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    right = _tiled(listed.select("lang", "part", "place", "groups", "source", "p_none", "kinds"), in_tile)
    key = ["lang", "part", "first", "second"]

    def compare(key: tuple, here: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        return _compare(key, here, known, words, in_tile)

    added = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(compare, "lang string, source string, item string, value bigint")
    return added.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
    words: int = WORDS, in_tile: int = TILE,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source differs from the others and which terms mark it.

    Null texts, languages and sources count as empty strings, which are groups
    like any other. Every row is a document, also where rows repeat. Terms are
    runs of letters; those in at least ``min_docs`` documents of the language are kept.
    ``p = 1 + floor(SCALE (count + 1) / (N + V))``; part ``pair`` sums
    ``floor((p - q)^2 / q)`` over the kept terms for every other source of the
    language, 0 without kept terms; part ``term`` lists the ``top`` terms that a group
    has more of than its language. Ties are ranked by item. An empty table, and
    a language with one source and no term that stands out, give no rows. Other
    columns are not read. Sums stay below 2^63 for up to a billion kept terms.

    Not lazy: counts, ids and groups are written to the shared folder. What a task
    of the comparison holds is bounded by ``words`` words of two tiles of ``in_tile`` groups.
    """
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = settle(term_counts(plain))
    terms = settle(vocabulary(counts, min_docs))
    cells = settle(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "id", "n", "total"))
    of_lang = terms.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("total").alias("lang_size"))
    of_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    by_name = Window.partitionBy("lang").orderBy("source")
    named = plain.select("lang", "source").distinct().withColumn("place", F.row_number().over(by_name).cast("bigint"))
    named = named.withColumn("groups", F.count("*").over(Window.partitionBy("lang")))
    zero = F.lit(0).cast("bigint")
    groups = settle(
        named.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
        .select("lang", "source", "place", "groups", *[F.coalesce(c, zero).alias(c) for c in ("size", "kinds", "lang_size")])
    )

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    p, q = _share(F.col("n"), F.col("size"), F.col("kinds")), _share(F.col("total"), F.col("lang_size"), F.col("kinds"))
    shares = cells.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    marked = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), "item", _gap(F.col("p"), F.col("q")).alias("value"))
    best = marked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    compared = pairs(bitsets(cells), groups, words, in_tile).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return compared.withColumn("rank", F.row_number().over(order)).unionByName(best)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
v AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT k) >= 3),
l AS (SELECT lang, count(*) AS kinds, sum(total) AS lang_size FROM v GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN v USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS size FROM c GROUP BY ALL),
g AS (SELECT lang, source, coalesce(size, 0) AS size, coalesce(kinds, 0) AS kinds, coalesce(lang_size, 0) AS lang_size
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN s USING (lang, source) LEFT JOIN l USING (lang)),
p AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
        1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.size + g.kinds) AS p,
        1 + 1000000000::HUGEINT * (v.total + 1) // (g.lang_size + g.kinds) AS q
      FROM g JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(t.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
                 FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) t
      ON t.lang = a.lang AND t.source = a.source AND t.item = b.source),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM u)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank FROM r WHERE part = 'pair' OR place <= 200
"""
