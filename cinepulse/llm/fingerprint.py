"""Order-independent document fingerprints: a homomorphic multiset hash.

A text is the multiset of its paragraphs: the pieces between line breaks, and inside
a line between sentence ends, so that a one-line text also has several; blank pieces
do not count. Every paragraph is hashed to a vector of 63 lanes with entries 0 or 1;
the fingerprint is the sum of these vectors, each lane modulo 2**21, and the number
of paragraphs. Equal multisets have equal fingerprints in any order, and a paragraph
is inserted or deleted by adding or subtracting its vector (``combine``).

Read as signs, the lanes also estimate how much two texts share: the mean product of
the signed lanes estimates the number of common paragraphs (standard error about
0.13 of the geometric mean of the sizes), ``likeness`` turns it into 0 to 1.

The 63 lanes are 21 words of 3 lanes. All of it is built-in column functions on one
row; only the next document's text moves, in one shuffle by ranges of the id.
Fingerprints of NULL and empty texts are that of no paragraph; two of those are
alike (1.0), and one of those is unlike any other (0.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cinepulse.llm.common import text_or_empty

WORDS = 21
LANE_BITS = 21
LANES = 3 * WORDS
ONES = 1 | 1 << LANE_BITS | 1 << 2 * LANE_BITS  # one in each lane of a word
LANE_MASK = (1 << LANE_BITS) - 1
#: Lane values of a word without their top bits: two of them add without a carry.
LOW = ONES * (LANE_MASK >> 1)
TOPS = ONES << LANE_BITS - 1
PARAGRAPH_END = r"\n|(?<=[.!?])\x20"


def _add(a: Column, b: Column) -> Column:
    """Sum of two words, each lane modulo 2**21: the low bits add without a carry out
    of the lane, the top bits are added by exclusive or."""
    low = a.bitwiseAND(F.lit(LOW)) + b.bitwiseAND(F.lit(LOW))
    return low.bitwiseXOR(a.bitwiseXOR(b).bitwiseAND(F.lit(TOPS)))


def _sub(a: Column, b: Column) -> Column:
    low = a.bitwiseOR(F.lit(TOPS)) - b.bitwiseAND(F.lit(LOW))
    return low.bitwiseXOR(a.bitwiseXOR(F.bitwise_not(b)).bitwiseAND(F.lit(TOPS)))


def paragraph_hashes(text: Column) -> Column:
    """One 64-bit hash per paragraph that is not blank."""
    parts = F.filter(F.split(text, PARAGRAPH_END), lambda p: F.length(F.trim(p)) > 0)
    return F.transform(parts, lambda p: F.xxhash64(p))


def fingerprint(text: Column) -> Column:
    """array<bigint>: number of paragraphs, then the 21 words of lane sums."""
    hashes = paragraph_hashes(text)
    # One word: the sum of (hash >> k) & ONES over the paragraphs.
    zero = F.array(F.lit(0).cast("long"), *[F.lit(0).cast("long")] * WORDS)

    def step(acc: Column, h: Column) -> Column:
        return F.array(acc[0] + 1, *[_add(acc[k + 1], F.shiftrightunsigned(h, k).bitwiseAND(F.lit(ONES))) for k in range(WORDS)])

    return F.aggregate(hashes, zero, step)


def combine(a: Column, b: Column, delete: bool = False) -> Column:
    """Fingerprint of the paragraphs of both texts, or of ``a`` without those of ``b``."""
    op = _sub if delete else _add
    count = a[0] - b[0] if delete else a[0] + b[0]
    return F.array(count, *[op(a[k], b[k]) for k in range(1, WORDS + 1)])


def as_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda w: F.lower(F.hex(w))), ".")


def signed_lanes(fp: Column) -> Column:
    """array<double> of the 63 lanes read as signs: 2 * ones - paragraphs."""
    lanes = [
        F.shiftrightunsigned(fp[k], LANE_BITS * j).bitwiseAND(F.lit(LANE_MASK)) * 2 - fp[0] for k in range(1, WORDS + 1) for j in range(3)
    ]
    return F.transform(F.array(*lanes), lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(ab: Column, aa: Column, bb: Column) -> Column:
    """Common share of two texts from the products of their signed lanes: 0 to 1."""
    union = aa + bb - ab
    return F.when((aa == ab) & (bb == ab), 1.0).when(union <= 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ab / union)))


# --- the next document --------------------------------------------------------


def range_bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most ``parts`` - 1 values that deal ``key`` into ranges of like row counts."""
    if parts < 2:
        return []
    fractions = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, fractions, max(10_000, 20 * parts))).first()[0]
    return sorted(set(found or []))


def range_part(key: Column, bounds: list[int]) -> Column:
    """Number of bounds that are at most ``key``, found in two steps of about the
    square root of their count (NULL keys: 0)."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    chunks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(c[0]).cast("long") for c in chunks])
    full = F.array(*[F.array(*[F.lit(b).cast("long") for b in c]) for c in chunks])

    def at_most(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= key))

    head = at_most(heads)
    return F.when(key.isNull() | (head == 0), 0).otherwise((head - 1) * step + at_most(F.element_at(full, F.greatest(head, F.lit(1)))))


def with_next(spark: SparkSession, rows: DataFrame, key: str, order: list[str], values: list[str], parts: int | None = None) -> DataFrame:
    """``values`` of the next row by (key, order) as ``next_<value>``; after the last
    row comes the first. One shuffle by ranges of ``key``: the rows with the smallest
    key of a range are also sent, as guests, to the range before."""
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(rows.select(key), key, parts)
    placed = rows.withColumn("_part", range_part(F.col(key), bounds))
    firsts = sorted((r[0], r[1]) for r in rows.select(key, range_part(F.col(key), bounds).alias("_part")).groupBy("_part").agg(F.min(key)).collect())
    if not firsts:
        return placed.select(*rows.columns, *[F.col(v).alias(f"next_{v}") for v in values])
    # At most ``parts`` rows: the first key of each range and the range before it.
    before = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts) if first is not None]
    guest_of = spark.createDataFrame(before, f"{key} long, _before int")
    # A guest stands behind all rows of the range that it visits.
    seats = F.when(F.col("_before").isNull(), F.array(F.struct(F.col("_part").alias("part"), F.lit(False).alias("guest")))).otherwise(
        F.array(
            F.struct(F.col("_part").alias("part"), F.lit(False).alias("guest")),
            F.struct(F.col("_before").alias("part"), F.lit(True).alias("guest")),
        )
    )
    dealt = placed.join(F.broadcast(guest_of), key, "left").withColumn("_seat", F.explode(seats)).drop("_part", "_before")
    w = W.partitionBy("_seat.part").orderBy("_seat.guest", key, *order)
    return (
        dealt.withColumns({f"next_{v}": F.lead(v).over(w) for v in values}).filter("not _seat.guest").select(*rows.columns, *[f"next_{v}" for v in values])
    )


def fingerprint_edits(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n/2) characters replaced by the first as many
    (or all) of the next document, ascending by id (ties: by text; after the last
    comes the first). Rows that repeat stay separate rows. A NULL id comes first.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = with_next(spark, rows.withColumn("fp", fingerprint(F.col("text"))), "doc_id", ["text"], ["text", "fp"])
    edited = F.concat(F.expr("substring(text, 1, length(text) - length(text) div 2)"), F.expr("substring(next_text, 1, length(text) div 2)"))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "fp", "next_fp")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "next_fp", fingerprint(F.col("edited")).alias("edited_fp"))
    lanes = rows.select("*", *[signed_lanes(F.col(c)).alias(f"{c}_lanes") for c in ("fp", "edited_fp", "next_fp")])
    products = {
        f"{a[0]}{b[0]}": dot(F.col(f"{a}_lanes"), F.col(f"{b}_lanes"))
        for a, b in (("fp", "fp"), ("edited_fp", "edited_fp"), ("next_fp", "next_fp"), ("fp", "edited_fp"), ("fp", "next_fp"))
    }
    return lanes.select("*", *[v.alias(k) for k, v in products.items()]).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fe"), F.col("ff"), F.col("ee")).alias("near_edited"),
        likeness(F.col("fn"), F.col("ff"), F.col("nn")).alias("near_next"),
    )
