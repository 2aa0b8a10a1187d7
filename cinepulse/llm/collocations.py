"""Collocations: phrases whose words stand together more often than their parts would, by stripes.

A stripe belongs to a (language, prefix) and maps each next word to the number of times
it follows the prefix inside a piece of text; the stripe of a word also holds the word's own
total. Tasks build stripes and merge them over many blocks of text (``HELD_ENTRIES`` entries
at a time), stripes of equal prefixes are merged elementwise after one shuffle (in sorted order, one open stripe at a time), and everything else is read from the merged
stripes: an entry is the count of an extended phrase and the total of the longer prefix
that it makes, and the largest entry of a stripe is the right half of the subsumption test
(the left half is the largest entry among phrases that end in the phrase).

A phrase can reach ``min_count`` only if all its parts do. Passes before the stripes count
64-bit hashes of words and pairs, then of each further length whose parts reached
``min_count``; what does sets a bit in a filter of a fixed size (``FILTER_BITS``, broadcast:
8 MB), and the stripes hold only phrases whose parts are all in it. A false positive
of the filter costs work and is counted like any other phrase; nothing frequent can be
missed, so the counts are exact at any size.

The stripe of a hot prefix (1 / ``HOT_SHARE`` of all counted phrases or more) is cut by a hash
of the next word into ``SEGMENTS`` parts, so that a prefix in a third of all texts, or one
with a whole vocabulary behind it, is merged by many tasks. The lookups of parts are broadcast below a checked size and salted above it. A language's first
rows come from ranks within 64 groups of its phrases, then from the rows these leave.

Words, pieces and case follow bytes of UTF-8: A-Z are lower-cased, line breaks and
``.,;:!?`` end a piece, blanks and tabs part words. NULL and empty texts have no words, a NULL
language is ``und``; repeated rows count each time; ties in the score go to the
higher count, then to the smaller phrase. Other columns are not looked at. An empty table
gives no rows. Long texts are read in blocks that carry the open piece's last words over;
memory follows the block, or the longest single word if that is longer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinepulse.functions.joins import lookup_join
from cinepulse.llm.common import lean, staged
from cinepulse.llm.textvec import BYTE_CODE, U64, _power_tables, mix

MIN_COUNT = 30
LONGEST = 4
SUBSUMED_PERCENT = 80
SCORE_SCALE = 2_000_000
TOP = 2000
BLOCK_BYTES = 1 << 20
STEP_BYTES = 1 << 18
FILTER_BITS = 1 << 26
#: A prefix that makes up 1 / HOT_SHARE of all counted phrases is hot: at most so many are.
HOT_SHARE = 4096
#: Parts of the stripe of a hot prefix.
SEGMENTS = 64
RANK_GROUPS = 64
#: Entries that a task gathers before it merges them, and merged entries of stripes that it holds.
MERGE_ENTRIES = 1 << 20
HELD_ENTRIES = 1 << 20

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _BREAK.copy()
_APART[[0x20, 0x09]] = True
_NEXT_GAP = re.compile(rb"[\t-\r .,;:!?]")
_STEP = U64(0xD6E8FEB86659FD93)

HASHES = "hash long, n long"
STRIPES = "lang string, size int, prefix string, segment int, next array<string>, n array<long>"
ENTRIES = "lang string, size int, prefix string, next string, n long"
_STRIPE_TYPES = pa.schema(
    [("lang", pa.string()), ("size", pa.int32()), ("prefix", pa.string()), ("segment", pa.int32()), ("next", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))]
)


# --- a block of text -------------------------------------------------------------


@dataclass
class Words:
    """The words of a block: place, hash (of the word alone, and with the language), language
    code, and whether a word and its successor are in one piece. The first ``known`` words were counted
    with the block before."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    plain: np.ndarray
    hashes: np.ndarray
    codes: np.ndarray
    joined: np.ndarray
    known: int
    open_words: list[bytes]


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _words(data: bytes, begins: list[int], codes: list[int], seeds: np.ndarray, known: int, keep: int) -> Words:
    raw = np.frombuffer(data.lower(), np.uint8)
    apart = np.ones(len(raw) + 2, bool)
    apart[1:-1] = _APART[raw]
    starts = np.flatnonzero(apart[:-1] & ~apart[1:])
    ends = np.flatnonzero(~apart[:-1] & apart[1:])
    up, down = _power_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, U64)
    for a in range(0, len(raw), STEP_BYTES):
        b = min(len(raw), a + STEP_BYTES)
        np.cumsum(BYTE_CODE[raw[a:b]] * up[a:b], out=total[a + 1 : b + 1])
        total[a + 1 : b + 1] += total[a]
    plain = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))
    code = np.asarray(codes, np.int64)[np.searchsorted(begins, starts, "right") - 1]
    breaks = np.cumsum(_BREAK[raw], dtype=np.int64)
    piece = breaks[starts]
    tail = np.flatnonzero(piece == breaks[-1])[-keep:] if len(raw) and keep else []
    return Words(
        raw, starts, ends, plain, mix(plain ^ seeds[code]), code, piece[:-1] == piece[1:], known, [raw[starts[i] : ends[i]].tobytes() for i in tail]
    )


def _blocks(langs: list[str], texts: list[bytes | None], longest: int, block_bytes: int) -> Iterator[tuple[Words, list[str]]]:
    """Words of groups of texts and the languages that their codes stand for. A text over
    the block size is cut where words are apart; the last words of the open piece go first
    into the next block."""
    names = sorted(set(langs))
    code = {n: i for i, n in enumerate(names)}
    seeds = np.array([_seed(n) for n in names], U64)
    group: list[bytes] = []
    begins, codes, size = [], [], 0

    def flush() -> Iterator[tuple[Words, list[str]]]:
        nonlocal size
        if group:
            yield _words(b"\n".join(group), begins, codes, seeds, 0, 0), names
        group.clear(), begins.clear(), codes.clear()
        size = 0

    for lang, text in zip(langs, texts):
        if not text:
            continue
        if len(text) <= block_bytes:
            begins.append(size)
            codes.append(code[lang])
            group.append(text)
            size += len(text) + 1
            if size >= block_bytes:
                yield from flush()
            continue
        at, before = 0, []
        while at < len(text):
            gap = _NEXT_GAP.search(text, at + block_bytes)
            stop = gap.start() if gap else len(text)
            found = _words(b" ".join([*before, text[at:stop]]), [0], [code[lang]], seeds, len(before), longest - 1)
            yield found, names
            at, before = stop, found.open_words
    yield from flush()


def _read(batch: pa.RecordBatch, longest: int, block_bytes: int) -> Iterator[tuple[Words, list[str]]]:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    return _blocks(batch.column("lang").to_pylist(), texts, longest, block_bytes)


# --- passes that count hashes: the filter -------------------------------------------


def _candidates(words: Words, bitmap: np.ndarray | None, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word, whether a phrase of ``length`` words begins there of which all shorter
    parts are in the filter (not looked at without one), and the hash of the phrase."""
    hashes, open_ = words.hashes, np.ones(len(words.hashes), bool)
    for k in range(1, length):
        held = open_ if bitmap is None else open_ & _in_filter(bitmap, hashes)
        open_ = held[:-1] & held[1:]
        if k == 1:
            open_ &= words.joined
        hashes = mix(hashes[:-1] * _STEP + words.hashes[k:])
    return open_, hashes


def _counted(words: Words, bitmap: np.ndarray | None, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the candidates of these lengths that end in a new word."""
    found = []
    for length in lengths:
        open_, hashes = _candidates(words, bitmap, length)
        found.append(hashes[max(0, words.known - length + 1) :][open_[max(0, words.known - length + 1) :]])
    return np.unique(np.concatenate(found), return_counts=True)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    hashes, place = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
    n = np.bincount(place, weights=np.concatenate([n for _, n in parts]), minlength=len(hashes)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], names=["hash", "n"])


def _marks(
    spark: SparkSession, docs: DataFrame, bitmap: np.ndarray | None, lengths: list[int], min_count: int, longest: int, block_bytes: int, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Filter bits of the phrases of these lengths that occur ``min_count`` times, and the
    hashes of the hot ones."""
    shared = None if bitmap is None else spark.sparkContext.broadcast(bitmap.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if shared is None else np.frombuffer(shared.value, U64)
        parts = []
        for batch in batches:
            for words, _ in _read(batch, longest, block_bytes):
                parts.append(_counted(words, known, lengths))
                if sum(len(h) for h, _ in parts) > MERGE_ENTRIES:
                    yield _merged(parts)
                    parts.clear()
        if parts:
            yield _merged(parts)

    counted = docs.mapInArrow(lean(run), HASHES).groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    counted = staged(spark, counted, "phrase-hashes")
    often = F.col("n").cast("decimal(20,0)") * HOT_SHARE >= F.lit(counted.agg(F.sum("n")).first()[0] or 0)
    hot = counted.filter(often).select("hash").toArrow()["hash"].to_numpy()  # HOT_SHARE rows at most
    slot = F.col("hash").bitwiseAND(F.lit(bits - 1))
    marked = counted.select(F.shiftright(slot, 6).alias("word"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
    rows = marked.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(U64), hot.astype(np.int64).view(U64)


def frequent_filter(
    spark: SparkSession, docs: DataFrame, min_count: int, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES, bits: int = FILTER_BITS
) -> tuple[np.ndarray, np.ndarray]:
    """Bits at the hashes of all phrases of fewer than ``longest`` words that occur ``min_count``
    times; ``docs`` has lang and text. Words and pairs are counted in one pass, each further
    length in another, by candidates whose parts are in the filter so far. Also the
    hashes of hot phrases, sorted. At most ``bits`` / 64 + ``HOT_SHARE`` rows a pass,
    whatever the input, come to the driver."""
    bitmap, hot = _marks(spark, docs, None, [1, 2][: longest - 1], min_count, longest, block_bytes, bits)
    for length in range(3, longest):
        more, hotter = _marks(spark, docs, bitmap, [length], min_count, longest, block_bytes, bits)
        bitmap, hot = bitmap | more, np.concatenate([hot, hotter])
    return bitmap, np.sort(hot)


def _in_filter(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & U64(len(bitmap) * 64 - 1)
    return (bitmap[(slot >> U64(6)).astype(np.int64)] >> (slot & U64(63))) & U64(1) == 1


# --- the last pass: stripes ----------------------------------------------------------


def _texts_of(words: Words, chosen: np.ndarray) -> pa.StringArray:
    """The words at these places as strings."""
    edge = np.zeros(len(words.raw) + 1, np.int8)
    edge[words.starts[chosen]] += 1
    edge[words.ends[chosen]] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    offsets = np.zeros(len(chosen) + 1, np.int32)
    np.cumsum(words.ends[chosen] - words.starts[chosen], out=offsets[1:])
    return pa.Array.from_buffers(pa.string(), len(chosen), [None, pa.py_buffer(offsets), pa.py_buffer(words.raw[inside])])


class StripeCounter:
    """Stripes of the blocks of a task, merged in the task before they leave it.

    Words of the filter get numbers by language and spelling; occurrences of phrases are
    rows of such numbers, counted by Arrow's grouping. ``HELD_ENTRIES`` bounds what is held.
    """

    def __init__(self, bitmap: np.ndarray, hot: np.ndarray, longest: int):
        self.bitmap, self.hot, self.longest = bitmap, hot, longest
        self._clear()

    def _clear(self) -> None:
        self.sizes: dict[str, int] = {}
        self.numbers: dict[tuple[str, str], int] = {}
        self.hashes: list[np.ndarray] = []  # of new words, by block: with and without the language
        self.counted: dict[int, pa.Table] = {}
        self.waiting: dict[int, list[np.ndarray]] = {k: [] for k in range(1, self.longest + 1)}
        self.n_waiting = 0

    def add(self, words: Words, langs: list[str]) -> None:
        for code, n in enumerate(np.bincount(words.codes[words.known :], minlength=len(langs))):
            if n:
                self.sizes[langs[code]] = self.sizes.get(langs[code], 0) + int(n)
        number = None
        for length in range(1, self.longest + 1):
            open_, hashes = _candidates(words, self.bitmap, length)
            at = np.flatnonzero(open_ if length == self.longest else open_ & _in_filter(self.bitmap, hashes))
            if number is None:
                if not len(at):
                    return
                number = self._numbered(words, langs, at)
            at = at[at + length > words.known]
            self.waiting[length].append(np.stack([number[at + i] for i in range(length)]))
            self.n_waiting += len(at)

    def _numbered(self, words: Words, langs: list[str], at: np.ndarray) -> np.ndarray:
        """The number of the word at each of these places."""
        spelled = _texts_of(words, at).dictionary_encode()
        size = len(spelled.dictionary)
        kinds, first, place = np.unique(words.codes[at] * size + spelled.indices.to_numpy(), return_index=True, return_inverse=True)
        code, word = np.divmod(kinds, size)
        names = spelled.dictionary.take(pa.array(word)).to_pylist()
        before = len(self.numbers)
        found = np.array([self.numbers.setdefault((langs[c], w), len(self.numbers)) for c, w in zip(code, names)], np.int32)
        fresh = first[found >= before]
        order = np.argsort(found[found >= before])
        self.hashes.append(np.stack([words.hashes[at[fresh]], words.plain[at[fresh]]])[:, order])
        out = np.full(len(words.starts), -1, np.int32)
        out[at] = found[place]
        return out

    def reduce(self) -> int:
        """Count what waits; returns the number of entries held."""
        for length, parts in self.waiting.items():
            if parts:
                rows = np.concatenate(parts, axis=1)
                names = [f"w{i}" for i in range(length)]
                table = pa.table([*map(pa.array, rows), pa.array(np.ones(rows.shape[1], np.int64))], names=[*names, "n"])
                if length in self.counted:
                    table = pa.concat_tables([self.counted[length], table])
                self.counted[length] = table.group_by(names, use_threads=False).aggregate([("n", "sum")]).rename_columns([*names, "n"])
                parts.clear()
        self.n_waiting = 0
        return sum(t.num_rows for t in self.counted.values())

    def stripes(self) -> Iterator[pa.RecordBatch]:
        """All stripes so far, by prefixes of 0 (only the number of words), 1, ... words."""
        self.reduce()
        langs = sorted(self.sizes)
        n = np.array([self.sizes[x] for x in langs], np.int64)
        empty = pa.array([""] * len(langs), pa.string())
        yield _batch(pa.array(langs, pa.string()), 0, empty, (n % SEGMENTS).astype(np.int32), np.arange(len(langs) + 1), empty, n)
        if self.numbers:
            names = pa.array([w for _, w in self.numbers] + [""], pa.string())
            lang_of = pa.array([x for x, _ in self.numbers], pa.string())
            hashes, plain = np.concatenate(self.hashes, axis=1)
            part = np.append((plain >> U64(40)).astype(np.int64) % SEGMENTS, 0)
            for length in range(1, self.longest):
                yield from self._of_length(length, names, lang_of, hashes, part)
        self._clear()

    def _of_length(self, length: int, names, lang_of, hashes: np.ndarray, part: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Stripes of prefixes of ``length`` words; those of single words hold their totals."""
        columns = [c.to_numpy() for c in self.counted[length + 1].columns] if length + 1 in self.counted else [np.zeros(0, np.int64)] * (length + 2)
        *prefix, after, n = columns
        if length == 1:
            word, total = (c.to_numpy() for c in self.counted[1].columns) if 1 in self.counted else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            prefix, after, n = [np.concatenate([word, prefix[0]])], np.concatenate([np.full(len(word), len(names) - 1), after]), np.concatenate([total, n])
        if not len(n):
            return
        key = hashes[prefix[0]]
        for p in prefix[1:]:
            key = mix(key * _STEP + hashes[p])
        segment = np.where(_among(key, self.hot), part[after], 0)
        order = np.lexsort((segment, *reversed(prefix)))
        cell = np.stack([*prefix, segment])[:, order]
        begins = np.flatnonzero(np.append(True, (cell[:, 1:] != cell[:, :-1]).any(axis=0)))
        heads = order[begins]
        spelled = [names.take(pa.array(p[heads])) for p in prefix]
        prefixes = pc.binary_join_element_wise(*spelled, " ") if length > 1 else spelled[0]
        yield _batch(
            lang_of.take(pa.array(prefix[0][heads])), length, prefixes, segment[heads].astype(np.int32),
            np.append(begins, len(order)), names.take(pa.array(after[order])), n[order],
        )


def _among(hashes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which hashes are in a sorted list."""
    if not len(chosen):
        return np.zeros(len(hashes), bool)
    return chosen[np.minimum(np.searchsorted(chosen, hashes), len(chosen) - 1)] == hashes


def _batch(lang, size: int, prefix, segment: np.ndarray, offsets: np.ndarray, after, n: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(offsets.astype(np.int32))
    columns = [
        lang, pa.array(np.full(len(segment), size, np.int32)), prefix, pa.array(segment),
        pa.ListArray.from_arrays(offsets, after), pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int64))),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_STRIPE_TYPES)


def _merge(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """Entries of merged stripes; equal (language, prefix, segment) follow each other. The
    last stripe of a batch may go on in the next one, so it is carried over, merged."""
    carried = None
    for batch in batches:
        rows = pa.Table.from_batches([batch.cast(_STRIPE_TYPES)] if carried is None else [carried, batch.cast(_STRIPE_TYPES)]).combine_chunks()
        if rows.num_rows:
            flat, open_ = _merge_rows(rows)
            carried = open_
            yield _frequent(flat, min_count)
    if carried is not None:
        whole = pa.Table.from_batches([carried])
        yield _frequent(_entries(whole, np.zeros(1, np.int64), np.array([0])), min_count)


def _merge_rows(rows: pa.Table) -> tuple[pa.Table, pa.RecordBatch]:
    """Merged entries of all stripes but the last, and the last as one row."""
    fresh = np.zeros(rows.num_rows, bool)
    for c in ("lang", "prefix", "segment", "size"):
        column = rows[c].chunk(0)
        fresh[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    stripe = np.cumsum(fresh)
    heads = np.flatnonzero(np.append(True, fresh[1:]))
    flat = _entries(rows, stripe, heads)
    last = pc.equal(flat["stripe"], int(stripe[-1]))
    tail = flat.filter(last).combine_chunks()
    key = {c: rows[c].chunk(0).slice(int(heads[-1]), 1) for c in ("lang", "size", "prefix", "segment")}
    open_ = _batch(
        key["lang"], key["size"][0].as_py(), key["prefix"], key["segment"].to_numpy(), np.array([0, tail.num_rows]), pa.array(tail["next"].to_pylist(), pa.string()), tail["n"].to_numpy()
    )
    return flat.filter(pc.invert(last)), open_


def _entries(rows: pa.Table, stripe: np.ndarray, heads: np.ndarray) -> pa.Table:
    """The summed entries of each stripe: stripe, lang, size, prefix, next, n."""
    lists = rows["next"].chunk(0)
    owner = pa.array(np.repeat(stripe, pc.list_value_length(lists).to_numpy()))
    flat = pa.table({"stripe": owner, "next": lists.flatten(), "n": rows["n"].chunk(0).flatten()})
    summed = flat.group_by(["stripe", "next"], use_threads=False).aggregate([("n", "sum")]).combine_chunks()
    at = pa.array(heads[summed["stripe"].to_numpy()])
    keys = {c: rows[c].chunk(0).take(at) for c in ("lang", "size", "prefix")}
    return pa.table({"stripe": summed["stripe"], **keys, "next": summed["next"], "n": summed["n_sum"]})


def _frequent(entries: pa.Table, min_count: int) -> pa.RecordBatch:
    kept = entries.filter(pc.or_(pc.equal(entries["size"], 0), pc.greater_equal(entries["n"], min_count))).drop_columns(["stripe"]).combine_chunks()
    return kept.to_batches()[0] if kept.num_rows else pa.RecordBatch.from_pylist([], schema=kept.schema)


def merged_stripes(spark: SparkSession, docs: DataFrame, min_count: int, longest: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Entries of all stripes, merged: lang, size (words in the prefix), prefix, next, n. An
    entry with an empty next word is the total of the word before it (of all words of the
    language if the prefix is empty); other entries below ``min_count`` are left out."""
    shared = spark.sparkContext.broadcast([a.tobytes() for a in frequent_filter(spark, docs, min_count, longest, block_bytes)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = StripeCounter(*(np.frombuffer(b, U64) for b in shared.value), longest)
        for batch in batches:
            for words, langs in _read(batch, longest, block_bytes):
                counter.add(words, langs)
                if counter.n_waiting > MERGE_ENTRIES and counter.reduce() > HELD_ENTRIES:
                    yield from counter.stripes()
        yield from counter.stripes()

    dealt = docs.mapInArrow(lean(run), STRIPES).repartition("lang", "prefix", "segment").sortWithinPartitions("lang", "prefix", "segment")
    return dealt.mapInArrow(lean(lambda batches: _merge(batches, min_count)), ENTRIES)


# --- phrases from stripes -----------------------------------------------------------------


def _rest(phrase: str, first: str) -> Column:
    """What stands behind ``first`` and one blank in ``phrase``."""
    return F.expr(f"substring({phrase}, length({first}) + 2)")


def phrase_counts(stripes: DataFrame) -> DataFrame:
    """lang, phrase, size, n of all phrases in merged stripes."""
    words = stripes.filter("size = 1 and next = ''").select("lang", F.col("prefix").alias("phrase"), "size", "n")
    longer = stripes.filter("next != ''").select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), (F.col("size") + 1).alias("size"), "n")
    return words.unionByName(longer)


def mine(
    spark: SparkSession,
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    subsumed_percent: int = SUBSUMED_PERCENT,
    top: int = TOP,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a (count), l and r
    (counts of the two parts at the worst cut), n (words of the language), score.

    score = ``SCORE_SCALE`` * a / (l + r), floored, at the cut that makes it lowest. A
    phrase is left out if a longer one around it has ``subsumed_percent`` of its count.
    """
    if longest < 2:
        raise ValueError("a phrase to be cut has two words at least")
    read = docs.select(F.coalesce(lang_col, F.lit("und")).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    stripes = staged(spark, merged_stripes(spark, read, min_count, longest), "stripes")
    counts = phrase_counts(stripes)
    found = counts.filter("size > 1")

    # One word longer is enough: inside a phrase two words longer lies one that is as frequent at least.
    right = stripes.filter("size > 1 and next != ''").select("lang", F.col("prefix").alias("phrase"), "n")
    left = found.filter("size > 2").select("lang", _rest("phrase", "substring_index(phrase, ' ', 1)").alias("phrase"), "n")
    around = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    swallowed = F.expr(f"cast(longer as decimal(20,0)) * 100 >= cast(n as decimal(20,0)) * {int(subsumed_percent)}")
    alone = found.join(around, ["lang", "phrase"], "left").filter(~F.coalesce(swallowed, F.lit(False)))

    cut = alone.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", _rest("phrase", "first"))
    for name, key in (("l", "first"), ("r", "rest")):
        side = counts.filter(F.col("size") < longest).select("lang", F.col("phrase").alias(key), F.col("n").alias(name))
        cut = lookup_join(cut, side, ["lang", key], salt_cols=["phrase"])
    score = F.expr(f"cast({SCORE_SCALE} as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    worst = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("worst"))
    scored = worst.select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    near = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", group).orderBy(*order))).filter(F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    sizes = stripes.filter("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
