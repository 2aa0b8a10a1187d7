"""Secret scans over an incremental blob ledger.

Every version of every path is addressed by its content (SHA-256). The ledger, a
Parquet table in a shared folder, records which (blob, rule, rule version) triples
were scanned and what was found; a run scans only the triples that it lacks and
joins the findings back to all paths that ever held the blob. Raising the version of
one rule rescans with that rule alone. Only built-in functions are used.

Offsets are code points of the blob, end exclusive. A match of a pattern that fails
its rule's length test is dropped and its characters are not tried again. NULL texts
are the empty blob; repeated rows are scanned once and reported once each; an empty
table leaves the ledger as it is; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cinepulse.llm.common import located, small_side, staged, stored, text_or_empty

LEDGER = "blob string, spans array<struct<start bigint, stop bigint>>, rule string, rule_version int"


@dataclass(frozen=True)
class Rule:
    """``pattern`` gives the matches; those whose ``group`` is shorter than
    ``min_length`` are dropped. Raise ``version`` with every change."""

    name: str
    pattern: str
    group: int
    min_length: int
    version: int = 1


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KEYWORDS = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
RULES = (
    Rule("assign", rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs are maximal, so runs of 24 and more are the matches of [0-9a-f]+ that pass.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)


def _pieces(text: Column, rule: Rule) -> Column:
    """Per match: characters before it since the last match, its length, and whether it passes."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    gaps = F.split(text, rule.pattern, -1)
    parts = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("match"), tested.alias("tested")),
        lambda p: F.struct(
            F.length(p["gap"]).alias("gap"), F.length(p["match"]).alias("size"), (F.length(p["tested"]) >= rule.min_length).alias("ok")
        ),
    )
    return F.when(text.rlike(rule.pattern), parts)


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rule, spans) for every rule that a row of ``blobs`` (blob, text, todo) names;
    spans is empty where nothing passes."""
    per_rule = F.array(
        *[
            F.when(
                F.array_contains("todo", r.name), F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version"), _pieces(F.col("text"), r).alias("parts"))
            )
            for r in rules
        ]
    )
    return blobs.select("blob", F.explode(F.filter(per_rule, lambda x: x.isNotNull())).alias("r")).select("blob", "r.*")


def _spans(parts: DataFrame) -> DataFrame:
    """Offsets from running sums of the pieces, one array of spans per (blob, rule)."""
    key = ["blob", "rule", "rule_version"]
    w = W.partitionBy(*key).orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    rows = parts.filter("size(parts) > 0").select(*key, F.posexplode("parts").alias("i", "p"))
    stops = rows.select(*key, "p.*", F.sum(F.col("p.gap") + F.col("p.size")).over(w).cast("long").alias("stop"))
    found = stops.filter("ok").select(*key, F.struct((F.col("stop") - F.col("size")).alias("start"), "stop").alias("span"))
    return found.groupBy(*key).agg(F.array_sort(F.collect_list("span")).alias("spans"))


def scan_versions(
    spark: SparkSession, versions: DataFrame, ledger: str, path_cols: list[str], text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Scan what the ledger lacks, append it, and return one row per version:
    ``path_cols``, blob, findings array<struct<start, kind_no, stop, kind>> by start, then rule."""
    spark.createDataFrame([], LEDGER).write.mode("append").partitionBy("rule", "rule_version").parquet(ledger)
    versions, text = stored(spark, versions), text_or_empty(text_col)
    keys = [F.col(c).alias(f"path_{i}") for i, c in enumerate(path_cols)]
    rows = staged(spark, located(versions, *keys, F.sha2(text, 256).alias("blob")), "blobs")

    wanted = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules])
    place = F.struct("loc_file", "loc_row")
    first = rows.groupBy("blob").agg(F.min(place).alias("place"))
    known = spark.read.schema(LEDGER).parquet(ledger).select("blob", "rule", "rule_version").distinct()
    unseen = first.select("*", F.explode(wanted).alias("r")).select("blob", "place", "r.*").join(known, ["blob", "rule", "rule_version"], "left_anti")
    todo = unseen.groupBy("blob", "place").agg(F.collect_list("rule").alias("todo"))
    # Rows that need not be scanned with every rule: copies, and blobs seen before.
    no_rule = F.array().cast("array<string>")
    less = (
        rows.join(todo.select("blob", "todo", F.col("place.loc_file").alias("f"), F.col("place.loc_row").alias("p")), "blob", "left")
        .select("loc_file", "loc_row", F.when((F.col("f") == F.col("loc_file")) & (F.col("p") == F.col("loc_row")), F.col("todo")).otherwise(no_rule).alias("todo"))
        .withColumn("todo", F.coalesce("todo", no_rule))
        .filter(F.size("todo") < len(rules))
    )
    less = staged(spark, less, "blobs-not-to-scan")
    every = F.array(*[F.lit(r.name) for r in rules])
    blobs = (
        located(versions, text.alias("text"))
        .join(small_side(less), ["loc_file", "loc_row"], "left")
        .withColumn("todo", F.coalesce("todo", every))
        .filter(F.size("todo") > 0)
        .select(F.sha2("text", 256).alias("blob"), "text", "todo")
    )
    parts = staged(spark, _scan(blobs, rules), "blob-matches")
    key = ["blob", "rule", "rule_version"]
    no_spans = F.array().cast("array<struct<start bigint, stop bigint>>")
    scanned = parts.select(*key).distinct().join(_spans(parts), key, "left").select("blob", F.coalesce("spans", no_spans).alias("spans"), "rule", "rule_version")
    scanned.write.mode("append").partitionBy("rule", "rule_version").parquet(ledger)
    return _report(spark, rows, ledger, path_cols, rules)


def _report(spark: SparkSession, rows: DataFrame, ledger: str, path_cols: list[str], rules: tuple[Rule, ...]) -> DataFrame:
    current = spark.createDataFrame([(r.name, r.version, i) for i, r in enumerate(rules)], "rule string, rule_version int, kind_no int")
    entries = spark.read.schema(LEDGER).parquet(ledger).filter("size(spans) > 0").join(F.broadcast(current), ["rule", "rule_version"])
    # A rerun after a failed append may have written a triple twice: count it once.
    entries = entries.dropDuplicates(["blob", "rule"])
    span = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("kind_no"), s["stop"].alias("stop"), F.col("rule").alias("kind")))
    found = entries.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(span))).alias("findings"))
    out = rows.join(small_side(staged(spark, found, "blob-findings")), "blob", "left")
    none = F.array().cast("array<struct<start: bigint, kind_no: int, stop: bigint, kind: string>>")
    return out.select(*[F.col(f"path_{i}").alias(c) for i, c in enumerate(path_cols)], "blob", F.coalesce("findings", none).alias("findings"))


def spans_text(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def kind_count(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda s: s["kind"] == kind)).cast("long")
