"""Licence notices, by a positional index of the rare words of templates.

The index holds, for each template, the places of its ``ANCHORS`` rarest words (highest
inverse document frequency over all templates and phrases) and, for each phrase, the
places of all its words. A text is read once into numbers of licence words (-1 for any
other word). Its licence words are looked up from the highest frequency score down; only
entries whose indexed words are all in the text are opened. Their postings are intersected by
relative position: an occurrence at word p of a word at place q of the entry votes for a
start at p - q, and a start counts if every indexed word votes for it, exactly for a
phrase and within ``SLACK`` words for a template (notices are wrapped, renumbered and
filled in). A start of a template is then checked in full: the score is the share of the
template's words, weighted by rarity, that stand within ``SLACK`` words of their places; it
is accepted from ``LEAST_SCORE`` on if all its mandatory phrases stand within the notice.

All places of base phrases are reported, overlapping ones too. Starts of a template
within ``SLACK`` words of each other are one place, the one of the highest score
(the first on ties). NULL and empty texts have no words and no places; equal rows
give equal results; an empty table gives no rows; columns of the input with the names of
the results are replaced. Texts are read in blocks cut between words, nothing is cut off:
memory is two bytes a word of the longest text, beside the block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cinepulse.llm.common import lean
from cinepulse.llm.license_texts import BASE_PHRASES, TEMPLATES, Template

ANCHORS = 3
SLACK = 4
LEAST_SCORE = 0.8
BLOCK_BYTES = 1 << 18
#: Starts checked at once: starts x words x shifts stays below this.
CHECK_CELLS = 1 << 21

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")

RESULTS = (
    "n_words long, base_places array<struct<label: string, word: long>>, "
    "notices array<struct<label: string, word: long, score: double>>, license_score double"
)
_PLACES = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
_NOTICES = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("score", pa.float64())]))


def split_words(text: str | bytes) -> list[bytes]:
    return _WORD.findall((text.encode() if isinstance(text, str) else text).lower())


class _Entry:
    """An indexed word sequence: word numbers, their weights, and which places are indexed."""

    def __init__(self, words: list[int], weights: np.ndarray, anchors: list[int]):
        self.words = np.array(words, np.int16)
        self.weights = weights / weights.sum()
        self.anchors = anchors  # places in the sequence, rarest word first


class LicenseIndex:
    def __init__(self, templates: list[Template] = TEMPLATES, base: dict[str, str] = BASE_PHRASES):
        self.templates, self.base = templates, base
        phrases = sorted({*base, *(p for t in templates for p in t.phrases)})
        texts = [split_words(x) for x in [*phrases, *(t.text for t in templates)]]
        vocabulary = sorted({w for ws in texts for w in ws})
        if len(vocabulary) >= 1 << 15:
            raise ValueError("more words than a 16-bit number holds")
        self.number = {w: i for i, w in enumerate(vocabulary)}
        held_by = np.zeros(len(vocabulary))
        for ws in texts:
            held_by[[self.number[w] for w in set(ws)]] += 1
        self.rarity = np.log((len(texts) + 1) / held_by)
        entries = [self._entry(ws, exact=i < len(phrases)) for i, ws in enumerate(texts)]
        self.phrases = dict(zip(phrases, entries))
        self.notices = entries[len(phrases) :]
        #: Indexed word -> entries that need it.
        self.postings: dict[int, list[_Entry]] = {}
        for e in entries:
            for w in {int(e.words[a]) for a in e.anchors}:
                self.postings.setdefault(w, []).append(e)

    def _entry(self, words: list[bytes], exact: bool) -> _Entry:
        numbers = [self.number[w] for w in words]
        weights = self.rarity[numbers]
        if exact:
            anchors = sorted(range(len(numbers)), key=lambda i: (-weights[i], i))
        else:
            firsts = {n: i for i, n in reversed(list(enumerate(numbers)))}
            anchors = sorted(firsts.values(), key=lambda i: (-weights[i], i))[:ANCHORS]
        return _Entry(numbers, weights, anchors)

    def word_numbers(self, text: bytes) -> np.ndarray:
        """Number of every word of the text, -1 where it is no licence word."""
        parts, at, get = [], 0, self.number.get
        while at < len(text):
            gap = _GAP.search(text, at + BLOCK_BYTES) if len(text) - at > BLOCK_BYTES else None
            stop = gap.start() if gap else len(text)
            words = _WORD.findall(text[at:stop].lower())
            parts.append(np.fromiter(map(get, words, repeat(-1)), np.int16, len(words)))
            at = stop
        return np.concatenate(parts) if parts else np.zeros(0, np.int16)

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[str, int]], list[tuple[str, int, float]], float]:
        """Words of the text, places of base phrases, accepted notices with their first
        word and score, and the best score of any aligned notice or base phrase."""
        numbers = self.word_numbers(text or b"")
        places = self._places(numbers)
        opened = self._opened(places)
        starts = {p: _intersect(e, places, 0) for p, e in self.phrases.items() if e in opened}
        base = sorted((int(s), label) for p, label in self.base.items() for s in starts.get(p, ()))
        best, notices = float(bool(base)), []
        for template, entry in zip(self.templates, self.notices):
            if entry not in opened:
                continue
            at = _intersect(entry, places, SLACK)
            score = self._scores(entry, numbers, at)
            at, score = _best_of_each(at, score)
            best = max(best, score.max(initial=0.0))
            held = score >= LEAST_SCORE
            for phrase in template.phrases:
                where, size = starts.get(phrase, np.zeros(0, np.int64)), len(self.phrases[phrase].words)
                first = np.searchsorted(where, at - SLACK)
                held &= (first < len(where)) & (np.append(where, 1 << 62)[first] + size <= at + len(entry.words) + SLACK)
            notices += [(int(s), template.label, float(x)) for s, x in zip(at[held], score[held])]
        return len(numbers), [(b, s) for s, b in base], [(b, s, x) for s, b, x in sorted(notices)], float(min(best, 1.0))

    def _places(self, numbers: np.ndarray) -> dict[int, np.ndarray]:
        """Where each indexed word of the text stands, from the highest rarity down."""
        found = np.flatnonzero(numbers >= 0)
        kinds = np.unique(numbers[found])
        indexed = sorted((int(k) for k in kinds if int(k) in self.postings), key=lambda k: -self.rarity[k])
        return {k: found[numbers[found] == k] for k in indexed}

    def _opened(self, places: dict[int, np.ndarray]) -> set[_Entry]:
        """Entries whose indexed words are all in the text."""
        missing: dict[_Entry, int] = {}
        for k in places:
            for e in self.postings[k]:
                missing[e] = missing.get(e, len({int(e.words[a]) for a in e.anchors})) - 1
        return {e for e, n in missing.items() if n == 0}

    def _scores(self, entry: _Entry, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Weighted share of the entry's words within ``SLACK`` words of their places, by start."""
        size, shifts = len(entry.words), 2 * SLACK + 1
        edge = np.full(SLACK + size, -1, np.int16)
        padded = np.concatenate([edge, numbers, edge])
        step = max(1, CHECK_CELLS // (size * shifts))
        out = np.zeros(len(at))
        for a in range(0, len(at), step):
            first = at[a : a + step, None] + len(edge) - SLACK + np.arange(size)
            hit = np.zeros(first.shape, bool)
            for d in range(shifts):
                hit |= padded[np.minimum(first + d, len(padded) - 1)] == entry.words
            out[a : a + step] = hit @ entry.weights
        return out


def _intersect(entry: _Entry, places: dict[int, np.ndarray], slack: int) -> np.ndarray:
    """Starts for which every indexed word of the entry votes within ``slack`` words."""
    rarest, *others = entry.anchors
    starts = places[int(entry.words[rarest])] - rarest
    for a in others:
        votes = places[int(entry.words[a])] - a
        nearest = np.searchsorted(votes, starts - slack)
        starts = starts[np.append(votes, 1 << 62)[nearest] <= starts + slack]
    return starts


def _best_of_each(at: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of starts that follow each other within ``SLACK`` words, the one of the highest score."""
    if not len(at):
        return at, score
    run = np.cumsum(np.diff(at, prepend=at[0]) > SLACK)
    order = np.lexsort((at, -score, run))
    first = order[np.flatnonzero(np.diff(run[order], prepend=-1))]
    return at[first], score[first]


def with_licenses(docs: DataFrame, text_col: str = "text", templates: list[Template] | None = None, base: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with n_words, base_places (label and word of every base phrase), notices
    (label, first word and score of accepted templates) and license_score (0 to 1)."""
    results = [c.split()[0] for c in ("n_words", "base_places", "notices", "license_score")]
    kept = [c for c in docs.columns if c not in results]
    templates = TEMPLATES if templates is None else templates
    base = BASE_PHRASES if base is None else base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LicenseIndex(templates, base)
        for batch in batches:
            texts = batch.column(text_col).cast(pa.binary())
            found = [index.scan(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.array([n for n, *_ in found], pa.int64()),
                    pa.array([[{"label": b, "word": s} for b, s in places] for _, places, _, _ in found], _PLACES),
                    pa.array([[{"label": b, "word": s, "score": x} for b, s, x in notices] for *_, notices, _ in found], _NOTICES),
                    pa.array([best for *_, best in found], pa.float64()),
                ],
                names=[*kept, *results],
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name not in results), RESULTS])
    return docs.mapInArrow(lean(run), schema)
