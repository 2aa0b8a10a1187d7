"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds the hashes of its distinct 5-word shingles (words between
ASCII white space, A-Z lower-cased; the whole sequence if there are fewer words).
Its signature has 256 minima. The forest has ``ORDERS`` orders of the signature; in
each, documents are sorted by the signature's values in that order, and those that
share the first ``DEPTH`` values form a region. Candidates are first the neighbours
inside a region: sorted by the further values, the nearest have the longest common
prefix, so the depth at which a document is compared adapts to how crowded its
region is. Candidates whose signatures agree well enough are checked on the full
sets, and links are gathered to components.

No partner is dropped for being one too many: regions that then still hold more than
one component are compared whole across components, in blocks of ``BLOCK_ROWS``
documents inside the tasks, by 16 bits of every shingle; these bound the similarity
from above, and only pairs that may reach it leave a task, to be checked on the full
sets. What may be missed is a pair
that shares no region in any order; with 40 orders of depth 5 that happens to about
2 in 100,000 pairs at similarity 0.75 and to fewer above.

Documents with equal sets are one node (the smallest id), so copies never meet as
pairs. Empty and NULL texts have the empty set and are linked with nothing. Rows
that share an id count as one document. Columns other than id and text are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cinepulse.llm.common import lean, small_side, staged
from cinepulse.llm.textvec import U64, grouped, mix, words_of

WORDS_PER_SHINGLE = 5
SIGNATURE = 256
ORDERS = 40
DEPTH = 5
FURTHER = 4  # values after the region's, packed in one sortable number
REACH = 2  # seats that the first pass looks ahead in an order
#: A region is compared in blocks of so many documents; in the first pass it is cut at
#: its further values, and by the id, if it has more than ``REGION_ROWS``.
BLOCK_ROWS = 2048
REGION_ROWS = 50_000
THRESHOLD = 75  # percent
#: Pairs whose 256 signature bytes agree less are not checked on the full sets: at a
#: true similarity of 0.75 this is 4.6 standard errors away.
LEAST_AGREEMENT = 160
SKETCHES = "id long, n_shingles long, set_hash binary, sketch binary, regions array<long>, further array<long>"

_rng = np.random.default_rng(0xF0E57)
_A = _rng.integers(1, 2**63, SIGNATURE, dtype=U64) * U64(2) + U64(1)
_B = _rng.integers(0, 2**63, SIGNATURE, dtype=U64) * U64(2)
_ORDER = np.stack([_rng.permutation(SIGNATURE)[: DEPTH + FURTHER] for _ in range(ORDERS)])
_FOLD = U64(0xD6E8FEB86659FD93)


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(parts[0]), len(parts), U64)
    for p in parts:
        out = mix(out * _FOLD + p)
    return out


def shingle_sets(texts: list[str | None]) -> Iterator[list[np.ndarray]]:
    """Sorted distinct shingle hashes of each text, in groups of texts."""
    data = [(t or "").encode().lower() for t in texts]  # bytes.lower() is A-Z only
    k = WORDS_PER_SHINGLE
    for first, stop in grouped(data):
        words, at = words_of(data[first:stop])
        n = max(0, len(words) - k + 1)
        shingles = _fold([words[j : j + n] for j in range(k)]) if n else words[:0]
        sets = []
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= k:
                sets.append(np.unique(shingles[a : b - k + 1]))
            elif b > a:
                sets.append(_fold([words[i : i + 1] for i in range(a, b)]))
            else:
                sets.append(words[:0])
        yield sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), SIGNATURE) minima as 32-bit numbers; the sets must not be empty."""
    values = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), SIGNATURE), np.uint32)
    work = np.empty_like(values)
    for j in range(SIGNATURE):
        np.multiply(values, _A[j], out=work)
        np.add(work, _B[j], out=work)
        out[:, j] = np.minimum.reduceat(work, starts) >> U64(32)
    return out


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, done = batch.column(0), 0
        for sets in shingle_sets(batch.column(1).to_pylist()):
            n = len(sets)
            some = [i for i, s in enumerate(sets) if len(s)]
            regions, further = np.zeros((n, ORDERS), np.int64), np.zeros((n, ORDERS), np.int64)
            sketch = np.zeros((n, SIGNATURE), np.uint8)
            if some:
                sig = signatures([sets[i] for i in some])
                picked = sig[:, _ORDER].astype(U64)  # documents, orders, values in order
                head = np.broadcast_to(np.arange(ORDERS, dtype=U64), picked.shape[:2])
                for j in range(DEPTH):
                    head = mix(head * _FOLD + picked[:, :, j])
                tail = np.zeros(picked.shape[:2], U64)
                for j in range(DEPTH, DEPTH + FURTHER):
                    tail = (tail << U64(16)) | (picked[:, :, j] >> U64(16))
                regions[some], further[some] = head.view(np.int64), tail.view(np.int64)
                sketch[some] = sig.astype(np.uint8)
            lists = np.array([0, *np.cumsum([ORDERS if len(s) else 0 for s in sets])], np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(done, n),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([r.tobytes() for r in sketch], pa.binary()),
                    pa.ListArray.from_arrays(lists, pa.array(regions[some].ravel())),
                    pa.ListArray.from_arrays(lists, pa.array(further[some].ravel())),
                ],
                names=["id", "n_shingles", "set_hash", "sketch", "regions", "further"],
            )
            done += n


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for sets in shingle_sets(batch.column(1).to_pylist()):
            packed = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(sets)), packed], names=["id", "shingles"])
            done += len(sets)


def _short_set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (id, shorts): 16 bits of every shingle, ascending."""
    for batch in batches:
        done = 0
        for sets in shingle_sets(batch.column(1).to_pylist()):
            packed = pa.array([(s >> U64(48)).astype(np.uint16).tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(sets)), packed], names=["id", "shorts"])
            done += len(sets)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, sketch_a, sketch_b) -> (a, b, agreement) of the pairs worth a full check."""
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SIGNATURE) for i in (2, 3))
        same = (left == right).sum(1)
        keep = pa.array(same >= LEAST_AGREEMENT)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(same.astype(np.int32)).filter(keep)], names=["a", "b", "agreement"]
        )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, shingles_a, shingles_b) -> (a, b) of the pairs that are similar enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= THRESHOLD * (len(x) + len(y) - common) and common > 0)
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


# --- components ----------------------------------------------------------------


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, comp): smallest node of the component of every node of ``links`` (a, b)."""
    both = staged(spark, links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(spark, both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        near = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "m").alias("comp"))
        # Follow the label's own label: halves the remaining distance.
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        after = staged(spark, near.join(jump, "comp", "left").select("node", "was", F.least("comp", "further").alias("comp")), "labels")
        labels = after.select("node", "comp")
        if after.filter("comp != was").isEmpty():
            return labels


# --- the forest ----------------------------------------------------------------


def _seats(spark: SparkSession, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every node's seat in every order: (region, part, further, id) of regions with
    more than one node, and the pairs that tie the parts of cut regions."""
    seats = nodes.select("id", F.explode(F.arrays_zip("regions", "further")).alias("s")).select("id", F.col("s.regions").alias("region"), F.col("s.further").alias("further"))
    sizes = staged(spark, seats.groupBy("region").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "forest-sizes")
    shared = staged(spark, seats.join(small_side(sizes), "region"), "forest")
    crowded = shared.filter(F.col("size") > REGION_ROWS)
    if crowded.isEmpty():
        return shared.select("id", "region", "further", F.col("region").alias("part"), "size"), spark.createDataFrame([], "a long, b long")
    counts = staged(spark, crowded.groupBy("region", "further").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")), "forest-cells")
    rows = shared.join(counts.drop("first"), ["region", "further"], "left")
    cells = F.ceil(F.col("n") / F.lit(REGION_ROWS))
    part = F.when(F.col("n").isNull(), F.col("region")).otherwise(F.xxhash64("region", "further", F.pmod(F.xxhash64("id", "region"), cells)))
    rows = rows.select("id", "region", "further", part.alias("part"), "size")
    parts = rows.filter(F.col("size") > REGION_ROWS).groupBy("region", "part").agg(F.min("id").alias("b"))
    ties = parts.join(parts.groupBy("region").agg(F.min("b").alias("a")), "region").filter("a < b").select("a", "b")
    return rows, ties


def _neighbours(seats: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of nodes at most ``REACH`` seats apart."""
    w = W.partitionBy("part").orderBy("further", "id").rowsBetween(1, REACH)
    pairs = seats.select("id", F.collect_list("id").over(w).alias("others")).filter(F.size("others") > 0)
    pairs = pairs.select("id", F.explode("others").alias("other"))
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).filter("a < b").distinct()


def _foreign_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, block, id, comp, shorts) sorted by cell -> (a, b, agreement) of the
    pairs of a cell that are in different components and may be similar enough: the
    shorts that one set shares with the other bound their intersection from above. A
    cell of two blocks compares the one with the other."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    table = np.zeros(1 << 16, bool)

    def compare(ids: np.ndarray, comps: np.ndarray, blocks: np.ndarray, shorts: list[bytes]) -> None:
        if len(ids) < 2 or (comps == comps[0]).all():
            return
        two = blocks.min() != blocks.max()
        sets = [np.frombuffer(x, np.uint16) for x in shorts]
        sizes = np.array([len(x) for x in sets])
        at, flat = np.r_[0, np.cumsum(sizes)], np.concatenate(sets)
        for i in range(len(ids) - 1):
            other = comps[i + 1 :] != comps[i]
            if two:
                other &= blocks[i + 1 :] != blocks[i]
            if not other.any():
                continue
            table[sets[i]] = True
            common = np.add.reduceat(table[flat[at[i + 1] :]], at[i + 1 : -1] - at[i + 1], dtype=np.int64)
            table[sets[i]] = False
            common = np.minimum(common, sizes[i])
            union = sizes[i] + sizes[i + 1 :] - common
            hit = other & (100 * common >= THRESHOLD * union)
            if hit.any():
                mate, mine = ids[i + 1 :][hit], ids[i]
                found.append((np.minimum(mate, mine), np.maximum(mate, mine), (100 * common // union)[hit]))

    def out() -> Iterator[pa.RecordBatch]:
        if found:
            a, b, n = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int32))], names=["a", "b", "agreement"])
            found.clear()

    held: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = [batch.column(i).to_numpy() for i in (0, 2, 3, 1)] + [batch.column(4).to_pylist()]
        if held is not None:
            part = [np.concatenate(x) for x in zip(held[:4], part[:4])] + [held[4] + part[4]]
        edges = np.flatnonzero(np.r_[True, part[0][1:] != part[0][:-1]])
        for i, j in zip(edges[:-1], edges[1:]):
            compare(*(x[i:j] for x in part[1:]))
        held = tuple(x[edges[-1] :] for x in part)
        yield from out()
    if held is not None:
        compare(*held[1:])
        yield from out()


def _open_pairs(spark: SparkSession, docs: DataFrame, seats: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Candidates across components in the regions that hold several: (a, b, agreement)."""
    rows = seats.filter(F.col("size") > 2).select("id", "region", "size")
    if labels is None:
        rows = rows.withColumn("comp", F.col("id"))
    else:
        rows = rows.join(labels.select(F.col("node").alias("id"), "comp"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    rows = staged(spark, rows, "seats-by-component")
    several = rows.groupBy("region").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low != high").select("region")
    rows = staged(spark, rows.join(small_side(staged(spark, several, "open-regions")), "region", "left_semi"), "open-seats")
    wanted = staged(spark, rows.select("id").distinct(), "to-compare")
    texts = docs.join(small_side(wanted), "id", "left_semi").select("id", "text")
    shorts = staged(spark, texts.mapInArrow(lean(_short_set_batches), "id long, shorts binary"), "shorts")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK_ROWS)).cast("int")
    rows = rows.join(shorts, "id").withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("id"), blocks).cast("int")})
    # A region of several blocks: every block meets every block, itself included.
    mate = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = rows.withColumn("mate", mate).withColumn("cell", F.xxhash64("region", F.least("block", "mate"), F.greatest("block", "mate")))
    cells = cells.select("cell", "block", "id", "comp", "shorts").repartition("cell").sortWithinPartitions("cell")
    return cells.mapInArrow(lean(_foreign_pairs), "a long, b long, agreement int").distinct()


def _across(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Pairs whose ends are in different components."""
    if labels is None:
        return pairs
    for c in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}")), c, "left")
    return pairs.filter(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b")


def _checked(spark: SparkSession, docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (staged) that are links, by their full sets."""
    wanted = staged(spark, pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "to-check")
    texts = docs.join(small_side(wanted), "id", "left_semi").select("id", "text")
    sets = staged(spark, texts.mapInArrow(lean(_set_batches), "id long, shingles binary"), "sets")
    side = {c: sets.select(F.col("id").alias(c), F.col("shingles").alias(f"shingles_{c}")) for c in "ab"}
    full = pairs.select("a", "b").hint("shuffle_merge").join(side["a"].hint("shuffle_merge"), "a").join(side["b"].hint("shuffle_merge"), "b")
    return full.select("a", "b", "shingles_a", "shingles_b").mapInArrow(lean(_linked), "a long, b long").distinct()


def near_links(spark: SparkSession, docs: DataFrame, sketches: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """(components of the linked nodes or None, nodes). ``docs``: id, text."""
    first = sketches.filter("n_shingles > 0").groupBy("set_hash").agg(F.min("id").alias("node"))
    nodes = staged(spark, sketches.join(first.select(F.col("node").alias("id"), "set_hash"), ["id", "set_hash"], "left_semi").dropDuplicates(["id", "set_hash"]), "nodes")
    seats, ties = _seats(spark, nodes)
    marks = nodes.select("id", "sketch")
    side = {c: marks.select(F.col("id").alias(c), F.col("sketch").alias(f"s{c}")) for c in "ab"}
    pairs = _neighbours(seats).unionByName(ties).distinct().join(side["a"], "a").join(side["b"], "b").select("a", "b", "sa", "sb")
    near = staged(spark, pairs.mapInArrow(lean(_agreeing), "a long, b long, agreement int").distinct(), "neighbours")
    links, labels = _link(spark, docs, near, None, None)
    rest = staged(spark, _open_pairs(spark, docs, seats, labels), "rest")
    _, labels = _link(spark, docs, rest, links, labels)
    return labels, nodes


def _link(spark: SparkSession, docs: DataFrame, candidates: DataFrame, links: DataFrame | None, labels: DataFrame | None):
    """Links and components with those among ``candidates`` (a, b, agreement; staged)."""
    # The best partners first; most others are in one component by then.
    best = F.row_number().over(W.partitionBy("b").orderBy(F.desc("agreement"), "a"))
    ranked = staged(spark, candidates.withColumn("rank", best), "ranked")
    for step in (F.col("rank") <= 2, F.col("rank") > 2):
        todo = staged(spark, _across(ranked.filter(step).select("a", "b"), labels), "pairs")
        if todo.isEmpty():
            continue
        found = _checked(spark, docs, todo)
        links = staged(spark, found if links is None else links.unionByName(found), "found")
        if not links.isEmpty():
            labels = components(spark, links)
    return links, labels


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (the smallest id of the component)."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketches = staged(spark, docs.mapInArrow(lean(_sketch_batches), SKETCHES), "sketches")
    labels, _ = near_links(spark, docs, sketches)
    rows = sketches.select("id", "n_shingles", "set_hash")
    first = rows.filter("n_shingles > 0").groupBy("set_hash").agg(F.min("id").alias("node"))
    if labels is not None:
        first = first.join(labels, "node", "left").select("set_hash", F.coalesce("comp", "node").alias("comp"))
    else:
        first = first.select("set_hash", F.col("node").alias("comp"))
    out = rows.join(first, "set_hash", "left")
    comp = F.when(F.col("n_shingles") > 0, F.col("comp")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", comp.alias("component_id"), F.equal_null(F.col("id"), comp).alias("kept"))
