"""Bulk ingest of metric text, of saved API responses and of notification payloads.

Every parser is a set of native column expressions over one column of text, so
it serves batch (``spark.read.text``) and streams (``readStream.text``) alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.layout import attach
from tidewatch.model import series_id

# The line formats of the text exposition. Possessive, so that a line
# is read once from left to right however long it is.
NAME = r"[a-zA-Z_][a-zA-Z0-9_]*+"
QUOTED = r'"(?:[^"\\]++|\\.)*+"'
LABELS = rf"\{{((?:\s*+{NAME}\s*+=\s*+{QUOTED}\s*+(?:,|(?=\}})))*+\s*+)\}}"
SAMPLE_LINE = rf"^([a-zA-Z_:][a-zA-Z0-9_:]*+)\s*+(?:{LABELS})?+\s*+(?<=[\s}}])([^\s#]++)(?:\s++(-?\d++))?+\s*+(?:#.*+)?+$"
TYPE_LINE = r"^#\s+TYPE\s+(\S+)\s+(\S+)\s*$"
LABEL_PAIR = rf'({NAME})\s*+=\s*+"((?:[^"\\]++|\\.)*+)"'
# Suffix of a sample's name and the types of the families that have such samples.
SUFFIX_TYPES = {
    "_bucket": ("histogram",), "_count": ("histogram", "summary"), "_sum": ("histogram", "summary"), "_total": ("counter",),
    "_info": ("info",),
}
FAMILY_SUFFIX = f"({'|'.join(SUFFIX_TYPES)})$"

RESPONSE = (
    "status string, data struct<resultType: string, "
    "result: array<struct<metric: map<string, string>, value: array<string>, values: array<array<string>>>>>"
)
PAYLOAD = "status string, alerts array<map<string, string>>"


def _number(text: Column) -> Column:
    """Metric number; ``NaN`` is undefined and becomes NULL."""
    named = F.lower(F.regexp_replace(text, r"^\+", ""))
    return (
        F.when(named == "inf", F.lit(float("inf")))
        .when(named == "-inf", F.lit(float("-inf")))
        .when(named == "nan", F.lit(None))
        .otherwise(text.try_cast("double"))
    )


def _unescaped(text: Column) -> Column:
    """Label value with its escapes resolved; a doubled backslash parts the text, so none is read twice."""
    plain = F.transform(
        F.split(text, r"\\\\"), lambda v: F.replace(F.replace(v, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))
    )
    return F.array_join(plain, "\\")


def _scanned(lines: DataFrame, line: str) -> DataFrame:
    """``lines`` with ``_text``, whether it is a sample (``_ok``), its label names, label values and number.

    A line is a sample if all of it is one: no label twice, and a number for a value.
    """
    part = lambda i: F.regexp_extract("_text", SAMPLE_LINE, i)
    pairs = lambda i: F.regexp_extract_all(part(2), F.lit(LABEL_PAIR), F.lit(i))
    rows = lines.withColumn("_text", F.trim(F.col(line)))
    rows = rows.withColumns({"_names": pairs(1), "_raw": pairs(2), "_number": part(3)})
    value = _number(F.col("_number"))
    once = F.size(F.array_distinct("_names")) == F.size("_names")
    proper = F.col("_text").rlike(SAMPLE_LINE) & once & (value.isNotNull() | (F.lower(F.regexp_replace("_number", r"^[+-]", "")) == "nan"))
    return rows.withColumns({"_ok": F.coalesce(proper, F.lit(False)), "_value": value})


def parse_text(lines: DataFrame, line: str = "value") -> DataFrame:
    """Sample lines as rows ``metric, labels, value, ts_ms``; comments and ``rejected`` lines are left out.

    Other columns of ``lines`` (target, scrape time, file) are kept, those named as the new ones excepted.
    """
    made = ("metric", "labels", "value", "ts_ms")
    keep = [c for c in lines.columns if c != line and c not in made]
    labels = F.map_from_arrays(F.when(F.col("_ok"), F.col("_names")), F.transform("_raw", _unescaped))
    return _scanned(lines, line).filter("_ok").select(
        *keep,
        F.regexp_extract("_text", SAMPLE_LINE, 1).alias("metric"),
        labels.alias("labels"),
        F.col("_value").alias("value"),
        F.regexp_extract("_text", SAMPLE_LINE, 4).try_cast("bigint").alias("ts_ms"),
    )


def rejected(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines as they came that are neither samples nor comments nor empty."""
    found = _scanned(lines, line).filter(~F.col("_ok") & (F.col("_text") != "") & ~F.startswith("_text", F.lit("#")))
    return found.select(*lines.columns)


def parse_types(lines: DataFrame, line: str = "value", target: Sequence[str] = ()) -> DataFrame:
    """Declared type per target and metric family, one row each."""
    text = F.trim(F.col(line))
    part = lambda i: F.regexp_extract(text, TYPE_LINE, i)
    return lines.filter(text.rlike(TYPE_LINE)).select(*target, part(1).alias("family"), part(2).alias("type")).distinct()


def typed_samples(lines: DataFrame, line: str = "value", target: Sequence[str] = ()) -> DataFrame:
    """Samples with declared type, ``le`` bound and series identity.

    ``target`` names the columns that tell scraped targets apart, such as job and
    instance. They become labels; a label of the same name that the target exposes
    is kept with ``exported_`` before it. Types hold for the target that declares
    them. A sample belongs to the family of its full name, or else to the one
    without its suffix if that family's type has samples with it. The declared
    types are written when this is called.
    """
    rows = parse_text(lines, line)
    types = parse_types(lines, line, target).groupBy(*target, "family").agg(F.max("type").alias("type"))
    rows = attach(rows.withColumn("family", F.col("metric")), types.withColumnRenamed("type", "_own"), [*target, "family"], "left")
    rows = rows.withColumn("family", F.regexp_replace("metric", FAMILY_SUFFIX, ""))
    rows = attach(rows, types.withColumnRenamed("type", "_base"), [*target, "family"], "left")
    fits = [F.endswith("metric", F.lit(end)) & F.col("_base").isin(*kinds) for end, kinds in SUFFIX_TYPES.items()]
    kind = F.coalesce(F.col("_own"), F.when(reduce(Column.__or__, fits), F.col("_base")))
    if target:
        exposed = F.transform_keys("labels", lambda k, _: F.when(k.isin(*target), F.concat(F.lit("exported_"), k)).otherwise(k))
        own = F.create_map(*[c for t in target for c in (F.lit(t), F.col(t).cast("string"))])
        rows = rows.withColumn("labels", F.map_concat(exposed, F.map_filter(own, lambda _, v: v.isNotNull())))
    out = rows.withColumn("type", kind).drop("family", "_own", "_base")
    return out.withColumns({"le": _number(F.col("labels")["le"]), "series_id": series_id()})


def parse_responses(docs: DataFrame, doc: str = "value") -> DataFrame:
    """Instant and range responses as rows ``labels, ts, value``."""
    keep = [c for c in docs.columns if c != doc]
    rows = (
        docs.withColumn("_r", F.from_json(doc, RESPONSE))
        .select(*keep, F.explode("_r.data.result").alias("_s"))
        .select(
            *keep,
            F.col("_s.metric").alias("labels"),
            F.explode(
                F.when(F.col("_s.values").isNotNull(), F.col("_s.values")).otherwise(F.array(F.col("_s.value")))
            ).alias("_v"),
        )
    )
    micros = F.round(F.get("_v", F.lit(0)).cast("decimal(20,6)") * 1000000).cast("bigint")
    return rows.select(
        *keep,
        F.map_filter("labels", lambda k, _: k != "__name__").alias("labels"),
        F.col("labels")["__name__"].alias("metric"),
        F.timestamp_micros(micros).alias("ts"),
        _number(F.get("_v", F.lit(1))).alias("value"),
    )


def payload_rollup(docs: DataFrame, doc: str = "value") -> DataFrame:
    """Notification payloads per status: documents and alerts in them."""
    parsed = docs.select(F.from_json(doc, PAYLOAD).alias("_p"))
    return parsed.groupBy(F.coalesce("_p.status", F.lit("unknown")).alias("status")).agg(
        F.count("*").alias("payloads"), F.sum(F.coalesce(F.size("_p.alerts"), F.lit(0))).alias("alerts")
    )
