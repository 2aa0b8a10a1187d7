"""Fill-in-the-middle: a wavelet matrix over character classes finds the cuts.

Every byte of a text in UTF-8 has a class: inside a code point, line break, other white
space, first of a word, other. A wavelet matrix holds the classes of a block of texts in
three bit levels with counted ranks, so ``rank(class, position)`` is three lookups. A unit
begins at each byte of certain classes: code points at all classes but the first, words at
one class, lines behind one class. The sum of the ranks of these classes is the number
of units before a position, which gives the units of every text and, by bisection on
ranks, the byte at which its k-th unit begins. Both cuts of all texts of a block are found
together.

The cuts and the form of a text depend on its id alone: h1 to h4 are the first four groups
of eight hex digits of sha256(``seed`` ``:`` id). Texts that hold a marker, empty texts and a
share of the others stay plain. The markers cannot overlap themselves or each other, so
the first one found when reading back is the one that was written.

NULL texts count as empty; a NULL id hashes like an empty one; equal rows give equal
results, so nothing depends on order; an empty table gives no rows. Columns of the input
with the names of the results are replaced. A text is never cut for processing: memory
is about six bytes for each byte of the block (``BLOCK_BYTES``, or the longest text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinepulse.llm.common import lean, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, those left plain and, of the others, those with the suffix first.
PLAIN_SHARE, SPM_SHARE = 10, 20
BLOCK_BYTES = 1 << 20

INNER, BREAK, BLANK, WORD, OTHER = range(5)
LEVELS = 3
#: The classes at which a unit begins; a line begins behind each line break.
UNITS = {"char": (BREAK, BLANK, WORD, OTHER), "word": (WORD,), "line": (BREAK,)}

_BLANKS = np.zeros(256, bool)
_BLANKS[[0x20, *range(0x09, 0x0E)]] = True
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[0x80:0xC0] = INNER
_CLASS[_BLANKS] = BLANK
_CLASS[0x0A] = BREAK

RESULTS = "form string, n long, prefix_chars long, middle_chars long, fim string"


def classes(raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Class of each byte of texts that begin at ``begins``; the first byte of a run that
    is not white space is a WORD."""
    out = _CLASS[raw]
    solid = ~_BLANKS[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = begins[begins < len(raw)]
    first[heads] = solid[heads]
    out[first] = WORD
    return out


class WaveletMatrix:
    """Ranks of symbols below 2**LEVELS: at each level the bits of the symbols, zeros
    moved stably before ones for the next level, and ones counted at every 64th bit."""

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        self.levels = []
        for bit in reversed(range(LEVELS)):
            ones = (symbols >> bit) & 1 == 1
            packed = np.packbits(ones, bitorder="little")
            cells = np.zeros(len(ones) // 64 + 1, np.uint64)
            cells.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(cells), np.int64)
            np.cumsum(np.bitwise_count(cells[:-1]), dtype=np.int64, out=before[1:])
            self.levels.append((cells, before, self.size - int(np.count_nonzero(ones))))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are ``symbol``."""
        low, high = np.zeros_like(at), at
        for bit, (cells, before, zeros) in zip(reversed(range(LEVELS)), self.levels):
            ones_low, ones_high = _ones(cells, before, low), _ones(cells, before, high)
            if symbol >> bit & 1:
                low, high = zeros + ones_low, zeros + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low

    def units(self, kinds: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        return np.sum([self.rank(k, at) for k in kinds], axis=0)

    def unit_start(self, kinds: tuple[int, ...], number: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Position of unit ``number`` (from 0, over the block) between ``low`` and ``high``,
        by bisection on ranks; ``high`` if there is none. Ranks are taken of the open ranges
        only: behind one that has closed at the end of the block there are no symbols."""
        low, high = low.copy(), high.copy()
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            reached = self.units(kinds, middle + 1) > number[open_]
            high[open_[reached]] = middle[reached]
            low[open_[~reached]] = middle[~reached] + 1
        return low


def _ones(cells: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
    cell, rest = at >> 6, (at & 63).astype(np.uint64)
    return before[cell] + np.bitwise_count(cells[cell] & ((np.uint64(1) << rest) - np.uint64(1)))


def cut_texts(texts: list[bytes], h1: np.ndarray, h2: np.ndarray, unit: str = "char") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, of its prefix and of prefix and middle, and the code points and
    bytes of the two cuts: (units, cut units, cut code points, cut bytes), the last three
    with two columns. The cuts are h1 and h2 modulo units + 1, in ascending order; words
    and lines belong to the part in which they begin, what stands before the first word to the prefix."""
    kinds = UNITS[unit]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    matrix = WaveletMatrix(classes(raw, begins))
    before = matrix.units(kinds, begins)
    units = matrix.units(kinds, ends) - before
    cuts = np.sort(np.stack([h1 % (units + 1), h2 % (units + 1)], axis=1), axis=1)
    places = np.stack([_cut_byte(matrix, kinds, unit, cuts[:, i], before, begins, ends) for i in (0, 1)], axis=1)
    chars = matrix.units(UNITS["char"], places) - matrix.units(UNITS["char"], begins)[:, None]
    return units, cuts, chars, places - begins[:, None]


def _cut_byte(matrix, kinds, unit, cut, before, begins, ends) -> np.ndarray:
    """Where the units from ``cut`` on begin. A line ends with its break: behind ``cut`` breaks."""
    if unit == "line":
        found = matrix.unit_start(kinds, before + cut - 1, begins, ends)
        return np.where(cut == 0, begins, np.minimum(found + 1, ends))
    return matrix.unit_start(kinds, before + cut, begins, ends)


def _grouped(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > limit:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(sizes):
        yield first, len(sizes)


def arrange(text: bytes, form: str, cut: tuple[int, int]) -> bytes:
    """The text with its parts in the order of ``form``, each behind its marker."""
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    prefix, middle, suffix = text[: cut[0]], text[cut[0] : cut[1]], text[cut[1] :]
    if form == "psm":
        return b"".join([p, prefix, s, suffix, m, middle])
    if form == "spm":
        return b"".join([s, suffix, p, prefix, m, middle])
    return text


def digest_groups(key: Column, seed: str) -> list[Column]:
    """h1 to h4: groups of eight hex digits of sha256(``seed``:key) as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "char",
    seed: str = "1",
    plain_share: int = PLAIN_SHARE,
    spm_share: int = SPM_SHARE,
) -> DataFrame:
    """``docs`` with form (plain, psm or spm), n (units of the text), prefix_chars and
    middle_chars (code points; NULL if plain) and fim (the text for training)."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {sorted(UNITS)}, not {unit!r}")
    results = [c.split()[0] for c in RESULTS.split(", ")]
    kept = docs.drop(*results)
    own = "_"  # names of our own, unlike any other
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    needed = dict(zip([f"{own}h{i}" for i in range(1, 5)], digest_groups(F.col(id_col), seed))) | {f"{own}text": text_or_empty(text_col)}
    keyed = docs.withColumns(needed).drop(*results)
    markers = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(f"{own}text").cast(pa.binary())
            for a, b in _grouped(pc.binary_length(column).to_numpy(), BLOCK_BYTES):
                part = batch.slice(a, b - a)
                texts = column.slice(a, b - a).to_pylist()
                h1, h2, h3, h4 = (part.column(f"{own}h{i}").to_numpy() for i in range(1, 5))
                units, _, chars, places = cut_texts(texts, h1, h2, unit)
                forms = [
                    "plain" if not t or h3[i] % 100 >= 100 - plain_share or any(m in t for m in markers) else "spm" if h4[i] % 100 < spm_share else "psm"
                    for i, t in enumerate(texts)
                ]
                plain = np.array([f == "plain" for f in forms])
                fim = [arrange(t, f, tuple(places[i])) for i, (t, f) in enumerate(zip(texts, forms))]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in names],
                        pa.array(forms, pa.string()),
                        pa.array(units.astype(np.int64)),
                        pa.array(chars[:, 0].astype(np.int64), mask=plain),
                        pa.array((chars[:, 1] - chars[:, 0]).astype(np.int64), mask=plain),
                        pa.array(fim, pa.binary()).cast(pa.string()),
                    ],
                    names=[*names, *results],
                )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), RESULTS])
    return keyed.mapInArrow(lean(run), schema)


def restored(fim: str = "fim", form: str = "form") -> Column:
    """The text that ``fim`` was made of: its parts behind the markers, put back in order."""
    parts = F.split(F.col(fim), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(*[F.get(parts, i) for i in (1, 3, 2)])
    spm = F.concat(*[F.get(parts, i) for i in (2, 3, 1)])
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(fim))
