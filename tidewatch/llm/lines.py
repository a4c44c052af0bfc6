"""Line dedup over content-defined chunks, with DataFrame functions only.

A rolling hash over the hashes of a line and the one before it says where a
chunk ends, so boundaries move with the text when lines are put in before them.
A chunk of several lines that occurs earlier in the corpus is removed, once its
bytes have been compared with those of the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEAN_LINES = 4


def _chunked(docs: DataFrame, text: str, mean_lines: int) -> DataFrame:
    """``docs`` with ``_lines`` and ``_chunks``, the chunks' text in order."""
    lines = docs.withColumn("_lines", F.split(F.col(text), "\n", -1))
    number = F.transform("_lines", lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("bigint"))
    hashed = lines.withColumn("_hash", number)
    n = F.size("_hash")
    before = F.concat(F.array(F.lit(0).cast("bigint")), F.slice("_hash", 1, F.greatest(n - 1, F.lit(0))))
    cut = F.zip_with("_hash", before, lambda here, last: (last * 31 + here) % mean_lines == 0)
    marked = hashed.withColumn("_cut", cut)
    ends = F.transform("_cut", lambda c, i: F.when(c | (i == F.size("_cut") - 1), i + 1))
    placed = marked.withColumn("_ends", F.array_compact(ends))
    start = F.concat(F.array(F.lit(0)), F.slice("_ends", 1, F.greatest(F.size("_ends") - 1, F.lit(0))))
    spans = placed.withColumn("_spans", F.arrays_zip(start.alias("a"), F.col("_ends").alias("b")))
    # the lines are named twice, so the optimiser does not move their making into the lambda;
    # they are picked one by one, because a slice copies the whole array first
    def body(s):
        return F.array_join(F.transform(F.sequence(s["a"] + 1, s["b"]), lambda i: F.element_at("_lines", i)), "\n")

    chunk = F.transform("_spans", lambda s: F.struct((s["b"] - s["a"]).alias("n"), body(s).alias("body")))
    return spans.withColumn("_chunks", F.when(F.size("_lines") > 0, chunk)).drop("_hash", "_cut", "_ends", "_spans")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", mean_lines: int = MEAN_LINES) -> DataFrame:
    """``docs`` with ``text`` less its repeated chunks, ``n_lines`` and ``lines_removed``.

    The first chunk by ``key`` (null last) and place stays; single lines are never
    removed. Rows that share key and text count as one document, whose chunks
    are not each other's repeats. A null text stays null and has no lines; an
    empty text has one. Further columns stay as they are.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "lines_removed")]
    tagged = docs.select(*columns, F.xxhash64(F.col(text)).alias("_tag"))
    place = F.struct(F.col(key).isNull().alias("z"), F.col(key).alias("k"), F.col("_tag").alias("t"), F.col("_c").alias("c"))
    # outer: a plain explode would have its input tested for emptiness below all projections, which repeats them
    chunks = _chunked(tagged.select(key, "_tag", text), text, mean_lines).select(key, "_tag", F.posexplode_outer("_chunks").alias("_c", "_chunk")).filter("_chunk.n > 1")
    chunks = chunks.select(place.alias("at"), F.col("_chunk.n").alias("n"), F.col("_chunk.body").alias("body"))
    chunks = chunks.withColumn("h", F.xxhash64("body"))
    often = chunks.groupBy("h").agg(F.count("*").alias("times")).filter("times > 1").select("h")
    likely = chunks.join(often, "h")
    first = likely.groupBy("h", "body").agg(F.min("at").alias("first"), F.count("*").alias("times")).filter("times > 1")
    first = first.select(F.col("h").alias("_h"), F.col("body").alias("_body"), "first")
    later = likely.join(first, (F.col("h") == F.col("_h")) & (F.col("body") == F.col("_body"))).filter("at <> first")
    gone = later.groupBy(F.col("at.k").alias("_k"), F.col("at.t").alias("_t")).agg(
        F.collect_set("at.c").alias("_gone")
    )
    left = tagged.join(gone, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_tag") == F.col("_t")), "left")
    kept = F.filter("_chunks", lambda c, i: ~F.array_contains("_gone", i))
    count = F.aggregate("_kept", F.lit(0), lambda s, c: s + c["n"])
    # never null; the row number keeps filters of the result from being computed anew below all projections
    number = F.monotonically_increasing_id() >= 0
    n_lines = F.when(number, F.when(F.col(text).isNull(), 0).otherwise(F.size("_lines")))
    done = _chunked(left, text, mean_lines).withColumn("_kept", F.when(F.col("_gone").isNotNull(), kept))
    return done.select(
        *[F.when(F.col("_kept").isNotNull(), F.array_join(F.transform("_kept", lambda c: c["body"]), "\n")).otherwise(F.col(text)).alias(text)
          if c == text else F.col(c) for c in columns],
        n_lines.alias("n_lines"),
        F.coalesce(n_lines - count, F.lit(0)).alias("lines_removed"),
    )


def report(docs: DataFrame) -> DataFrame:
    found = dedup(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "lines_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = f"""
WITH texts AS (SELECT doc_id, string_split(text, chr(10)) AS parts, text FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM texts),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines),
cuts AS (SELECT *, ((coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0) * 31 + h) % {MEAN_LINES} = 0)::INT AS cut FROM hashed),
placed AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM cuts),
chunks AS (SELECT doc_id, c, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n FROM placed GROUP BY doc_id, c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, c) AS place FROM chunks),
kept AS (SELECT doc_id, sum(n)::INT AS n_lines, coalesce(sum(n) FILTER (n > 1 AND place > 1), 0)::INT AS lines_removed,
    coalesce(string_agg(body, chr(10) ORDER BY c) FILTER (n = 1 OR place = 1), '') AS body FROM ranked GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(lines_removed, 0) AS lines_removed,
    sha256(CASE WHEN lines_removed > 0 THEN body ELSE coalesce(text, '') END) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)
"""
