"""Secret scans that never look at the same bytes twice: an incremental ledger of content-addressed blobs.

Every version of every text is a blob, named by the SHA-256 of its bytes. The
ledger remembers which blob was scanned by which version of which rule. A new
snapshot, or a new rule version, scans only the pairs that the ledger lacks;
findings are stored per blob and joined back to every path that ever held it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import settle, shared_dir

LOCAL_BLOBS = 1 << 18  # names a task remembers before it forgets them all; later stages drop what it sends twice


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` bytes or more."""

    kind: str
    pattern: bytes
    least: int = 0
    group: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def find(self, data: bytes) -> list[tuple[int, int]]:
        """Byte spans of what matches."""
        found = re.finditer(self.pattern, data)  # compiled once by the module's cache
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


# Fixed values. Byte patterns fold ASCII letters only. A hexadecimal run of 32 or more is the run that `[0-9a-f]+` takes whole.
BASE = (
    Rule("assign", rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", rb"AKIA[A-Z0-9]+", 16),
    Rule("hex", rb"[0-9a-f]{32,}", 32),
)
MORE = (
    Rule("pem", rb"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("bearer", rb"(?i:bearer)\x20+([A-Za-z0-9._~+/-]+=*)", 20, 1),
)
RULES = BASE + MORE

FOUND = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("rule", T.StringType())])
)
_SCANS = T.StructType(
    [T.StructField("blob", T.BinaryType()), T.StructField("rules", T.ArrayType(T.StringType())), T.StructField("found", FOUND)]
)


def scan(data: bytes, rules: Sequence[Rule]) -> list[tuple[int, int, str]]:
    """``start, stop, rule name`` of every finding, in code points, end exclusive."""
    spans = [(a, b, rule.name) for rule in rules for a, b in rule.find(data)]
    if not spans:
        return []
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80, out=before[1:])
    return [(int(before[a]), int(before[b]), name) for a, b, name in spans]


def _packed(rows: DataFrame) -> DataFrame:
    """``blob, packed``: texts compressed, copies within a task mostly left out, so that a hot text shrinks before it moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, sent = zstandard.ZstdCompressor(level=1).compress, set()
        for batch in batches:
            names, first = batch.column(0).to_pylist(), []
            for i, name in enumerate(names):
                if name not in sent:
                    if len(sent) >= LOCAL_BLOBS:
                        sent.clear()
                    sent.add(name)
                    first.append(i)
            texts = batch.column(1).cast(pa.large_binary()).take(pa.array(first, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in first], pa.binary()), pa.array([pack(x.as_buffer()) for x in texts], pa.binary())], names=["blob", "packed"]
            )

    return rows.mapInArrow(run, "blob binary, packed binary")


def _scanned(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The ledger's rows of ``blob, packed, todo``."""
    known = {rule.name: rule for rule in rules}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("rule", pa.string())]))
        for batch in batches:
            todo = batch.column(2).to_pylist()
            found = [
                [{"start": a, "stop": b, "rule": name} for a, b, name in scan(unpack(text.as_buffer()), [known[n] for n in names])]
                for text, names in zip(batch.column(1), todo)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(todo, pa.list_(pa.string())), pa.array(found, kind)], names=["blob", "rules", "found"]
            )

    return texts.mapInArrow(run, _SCANS)


class Ledger:
    """Tables of a folder that all executors reach: ``paths/<run>`` (path, blob) and ``scans/<run>`` (blob, rules, findings).

    A run is written whole or not at all: readers take only runs whose write was
    committed. A run that failed between its two tables is simply made again;
    what it had scanned is not scanned twice.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _runs(self, table: str) -> list[str]:
        """Committed runs, oldest first. Their number is that of snapshots, not of rows."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        top = hadoop.Path(f"{self.folder}/{table}")
        files = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(top):
            return []
        runs = [(s.getModificationTime(), s.getPath()) for s in files.listStatus(top)]
        return [p.toString() for _, p in sorted(runs, key=lambda r: (r[0], r[1].getName())) if files.exists(hadoop.Path(p, "_SUCCESS"))]

    def _write(self, rows: DataFrame, table: str) -> str:
        at = f"{self.folder}/{table}/{uuid.uuid4().hex}"
        rows.write.parquet(at)
        return at

    def scans(self) -> DataFrame:
        """``blob, rules, found`` of all runs: a blob has one row per run in which it met new rules."""
        runs = self._runs("scans")
        return self.spark.read.schema(_SCANS).parquet(*runs) if runs else self.spark.createDataFrame([], _SCANS)

    def paths(self) -> DataFrame | None:
        """``path, blob`` of every version of every snapshot."""
        runs = self._runs("paths")
        return self.spark.read.parquet(*runs) if runs else None

    def update(self, docs: DataFrame, path: Sequence[str] = ("doc_id",), text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
        """Take in a snapshot; returns its ``path, blob`` rows.

        Null texts count as empty, and every row is a version of its path, also
        where paths are null or repeat. Texts move once, compressed, to where
        their blob is looked up; if few blobs are new, Spark sends those to the
        texts instead. Other columns are not read.
        """
        whole = F.coalesce(F.col(text), F.lit("")).cast("string")
        blob = F.unhex(F.sha2(whole, 256))
        at = self._write(docs.select(F.struct(*[F.col(c) for c in path]).alias("path"), blob.alias("blob")), "paths")
        versions = self.spark.read.parquet(at)
        wanted = versions.select("blob").distinct()
        names = F.array(*[F.lit(rule.name) for rule in rules])
        seen = self.scans().groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
        todo = wanted.join(seen, "blob", "left").select("blob", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
        todo = settle(todo.filter(F.size("todo") > 0))
        fresh = _packed(docs.select(blob.alias("blob"), whole.alias("text"))).join(todo, "blob").dropDuplicates(["blob"])
        self._write(_scanned(fresh, rules), "scans")
        return versions

    def findings(self, rules: Sequence[Rule] = RULES) -> DataFrame:
        """``blob, found`` of blobs in which these rule versions found something; by start, then as the rules are listed."""
        names = [rule.name for rule in rules]
        place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("f.rule"))
        each = self.scans().filter(F.size("found") > 0).select("blob", F.explode("found").alias("f")).filter(F.col("f.rule").isin(names))
        spans = each.select("blob", F.struct("f.start", place.alias("place"), "f.stop", F.substring_index("f.rule", "@", 1).alias("kind")).alias("f"))
        return spans.groupBy("blob").agg(F.array_sort(F.collect_list("f")).alias("found"))

    def report(self, versions: DataFrame | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
        """``path, blob, found`` of every version taken in, or of those given; ``found`` is empty where nothing is."""
        versions = self.paths() if versions is None else versions
        found = self.findings(rules)
        kind = found.schema["found"].dataType
        return versions.join(found, "blob", "left").select("path", "blob", F.coalesce("found", F.array().cast(kind)).alias("found"))


def digests(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row, through a ledger of its own.

    Without findings the digest is that of the empty string and ``spans`` is
    empty. Runs the scan when called, as the ledger is a table.
    """
    spark = docs.sparkSession
    ledger = Ledger(spark, folder or f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}")
    found = ledger.report(ledger.update(docs))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["stop"].cast("string"))))

    base = F.filter("found", lambda f: f["place"] <= len(BASE))

    def count(kind):
        return F.size(F.filter("found", lambda f: f["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(rule.kind) for rule in BASE]
    return found.select(F.col("path.doc_id").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_SQL = [
    ("assign", rf"""({'|'.join(map(_either, ('password', 'passwd', 'secret', 'token', 'api_?key')))})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("pem", "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", 0, 0),
    ("bearer", rf"{_either('bearer')}\x20+([A-Za-z0-9._~+/-]+=*)", 1, 20),
]
ORACLE = (
    "WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents), m AS ("
    + " UNION ALL ".join(
        f"SELECT k, '{kind}' AS kind, {i} AS place, {least} AS least, regexp_extract_all(t, '{p}') AS ms, regexp_extract_all(t, '{p}', {group}) AS gs, string_split_regex(t, '{p}') AS ps FROM d"
        for i, (kind, p, group, least) in enumerate(_SQL)
    )
    + """),
e AS (SELECT k, kind, place, least, unnest(ms) AS s, unnest(gs) AS g, unnest(ps[:len(ms)]) AS p, unnest(range(len(ms))) AS i FROM m),
x AS (SELECT *, sum(length(p) + length(s)) OVER (PARTITION BY k, place ORDER BY i) AS stop FROM e),
f AS (SELECT k, kind, place, (stop - length(s))::BIGINT AS a, stop::BIGINT AS b FROM x WHERE length(g) >= least),
r AS (SELECT k, count(*) FILTER (place = 0) AS n0, count(*) FILTER (place = 1) AS n1, count(*) FILTER (place = 2) AS n2,
        string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) FILTER (place < 3) AS base,
        string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) AS spans FROM f GROUP BY k)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN r USING (k)"""
)
