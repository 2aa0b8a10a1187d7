"""Language ID: segmentation-marginalised unigrams over a fixed public vocabulary.

Each language is a unigram distribution over the pieces of a public SentencePiece
model. The likelihood of a word is the sum over all its segmentations into pieces,
computed by the forward algorithm, vectorised over words of one length; a text's is
the product over its words. The distributions are fitted by expectation
maximisation (forward-backward) on a bounded sample per language: rows in the order of
a hash of the id, at most ``SAMPLE_ROWS``, until their whole texts reach
``SAMPLE_CHARS`` characters (the row that passes it is the last). Of rows with one
id the least text is learned.

Words are the runs of letters of the lower-cased text, of any length, marked at the
start as the pieces are; a character outside the vocabulary has a fixed small
probability. Pieces that no such word can hold are left out. Words over ``LONG``
letters are summed one by one in logarithms, since their likelihood is below the
smallest double; scoring holds one block of such a word, learning the whole word
(16 bytes a letter and language). A NULL text or one without a letter is
``und`` with score 0, as is every text if there is nothing to learn from. Equally
likely languages: the first by name. The score is the posterior of the prediction
under equal priors. Scoring is a map over batches, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cinepulse.llm.common import held_out, lean, with_columns

SAMPLE_ROWS = 300
SAMPLE_CHARS = 3_000_000
ID_BUCKETS = 64  # the lowest hashes of a language are found in each bucket first
LONG = 30  # 1e-8 to this power is a double
BLOCK = 1 << 14  # letters of a long word looked up at a time
ITERATIONS = 3
SMOOTHING = 0.02
UNKNOWN = 1e-8  # of one character that is no piece
CACHE_WORDS = 400_000
GROUP_WORDS = 1 << 18
TABLE_BITS = 22


class _Letters:
    """Runs of letters. A class that names each number character such as ``½`` would be searched
    from one to the next for every character of the text: they are split off afterwards."""

    _runs = re.compile(r"[^\W\d_]+")

    def findall(self, text: str) -> list[str]:
        words = self._runs.findall(text)
        if all(map(str.isalpha, words)):
            return words
        return [w for x in words for w in "".join(c if c.isalpha() else " " for c in x).split(" ") if w]


WORD = _Letters()
MARK = "▁"  # what the vocabulary writes for the start of a word

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(model_path: str) -> list[str]:
    """Ordinary pieces of a SentencePiece model that lower-cased words can hold."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = (i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return sorted({p for i in ids if (p := sp.id_to_piece(i)) and p == p.lower() and (p == MARK or p.removeprefix(MARK).isalpha())})


def _hash(codes: np.ndarray) -> np.ndarray:
    """Hash of the rows of a matrix of code points."""
    h = np.full(len(codes), codes.shape[1], U64)
    for j in range(codes.shape[1]):
        h = _extend(h, codes[:, j])
    return h


def _extend(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    h = (h ^ code.astype(U64)) * _BASE
    return h ^ (h >> U64(29))


class Vocabulary:
    """Pieces by hash, in a table that is indexed by the hash's top bits."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.reach = max(map(len, pieces), default=1)
        self.keys = np.empty(len(pieces) + 1, U64)
        for n in range(1, self.reach + 1):
            at = [i for i, p in enumerate(pieces) if len(p) == n]
            if at:
                self.keys[at] = self.start(_codes([pieces[i] for i in at], n), 0, n)
        self.keys[-1] = 0
        none = len(pieces)
        order = np.argsort(self.keys[:-1], kind="stable")
        slots = (self.keys[order] >> U64(64 - TABLE_BITS)).astype(np.int64)
        self.tables = []
        while len(order):  # pieces that share a slot go to the next table
            table = np.full(1 << TABLE_BITS, none, np.int32)
            fresh = np.r_[True, slots[1:] != slots[:-1]]
            table[slots[fresh]] = order[fresh]
            self.tables.append(table)
            order, slots = order[~fresh], slots[~fresh]

    @staticmethod
    def start(codes: np.ndarray, at: int, n: int) -> np.ndarray:
        h = np.full(len(codes), 1, U64)
        for j in range(at, at + n):
            h = _extend(h, codes[:, j])
        return h

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of the piece with this hash, len(pieces) if there is none."""
        slots = (hashes >> U64(64 - TABLE_BITS)).astype(np.int64)
        found = np.full(len(hashes), len(self.pieces), np.int32)
        for table in self.tables:
            ids = table[slots]
            hit = self.keys[ids] == hashes
            found[hit] = ids[hit]
        return found

    def spans(self, codes: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """(start, stop) -> piece index per word, for words of one length."""
        length = codes.shape[1]
        out = {}
        for a in range(length):
            h = np.full(len(codes), 1, U64)
            for b in range(a + 1, min(length, a + self.reach) + 1):
                h = _extend(h, codes[:, b - 1])
                out[a, b] = self.find(h)
        return out

    def ends(self, codes: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Pieces of one word that end behind the letters ``start`` to ``stop``: row b, column
        n - 1 is the piece of n letters that ends at start + 1 + b, if it lies in the word."""
        out = np.full((stop - start, self.reach), len(self.pieces), np.int32)
        first = max(0, start + 1 - self.reach)
        part = codes[first:stop]
        h = np.full(len(part), 1, U64)
        for n in range(1, min(self.reach, len(part)) + 1):
            h = _extend(h[: len(part) - n + 1], part[n - 1 :])  # of the n letters from each place
            end = first + n + np.arange(len(h))
            inside = end > start
            out[end[inside] - start - 1, n - 1] = self.find(h[inside])
        return out


def _codes(words: list[str], n: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``words``, code points) of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int32, len(words))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, _codes([words[i] for i in at], int(n))


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    probs: np.ndarray  # (pieces + 1, languages); the last row is no piece

    def __post_init__(self):
        self.vocabulary = Vocabulary(self.pieces)

    def span_probs(self, spans: dict, a: int, b: int) -> np.ndarray:
        p = self.probs[spans[a, b]]
        return np.maximum(p, UNKNOWN) if b - a == 1 else p

    def forward(self, spans: dict, n: int, length: int) -> list[np.ndarray]:
        alpha = [np.ones((n, len(self.languages)))]
        for b in range(1, length + 1):
            total = np.zeros_like(alpha[0])
            for a in range(max(0, b - self.vocabulary.reach), b):
                total += alpha[a] * self.span_probs(spans, a, b)
            alpha.append(total)
        return alpha

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log likelihood of each marked word in each language."""
        out = np.empty((len(words), len(self.languages)))
        for at, codes in by_length(words):
            if codes.shape[1] > LONG:
                for i, word in zip(at, codes):
                    out[i] = self.long_score(word)
                continue
            spans = self.vocabulary.spans(codes)
            out[at] = np.log(self.forward(spans, len(at), codes.shape[1])[-1])
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece, summed over segmentations (forward-backward)."""
        totals = np.zeros_like(self.probs)
        for at, codes in by_length(words):
            if codes.shape[1] > LONG:
                for i, word in zip(at, codes):
                    self.long_expected(word, counts[i], totals)
                continue
            length, spans = codes.shape[1], self.vocabulary.spans(codes)
            alpha = self.forward(spans, len(at), length)
            beta = [np.ones_like(alpha[0])] * (length + 1)
            for a in range(length - 1, -1, -1):
                total = np.zeros_like(alpha[0])
                for b in range(a + 1, min(length, a + self.vocabulary.reach) + 1):
                    total += self.span_probs(spans, a, b) * beta[b]
                beta[a] = total
            weight = counts[at] / alpha[length]
            for (a, b), ids in spans.items():
                use = alpha[a] * self.span_probs(spans, a, b) * beta[b] * weight
                for lang in range(len(self.languages)):
                    totals[:, lang] += np.bincount(ids, use[:, lang], len(totals))
        return totals


    # Long words: the same sums in logarithms, letter by letter.

    def log_ends(self, ends: np.ndarray) -> np.ndarray:
        """Log probabilities (letter, piece length, language) of ``Vocabulary.ends``."""
        with np.errstate(divide="ignore"):
            logs = np.log(self.probs)[ends]
        logs[:, 0] = np.maximum(logs[:, 0], np.log(UNKNOWN))
        return logs

    def log_forward(self, codes: np.ndarray, keep: bool) -> np.ndarray:
        """Log alpha behind every letter of a word if ``keep``, else behind the last ones."""
        reach = self.vocabulary.reach
        held = np.zeros((1, len(self.languages)))  # alpha before the first letter
        for start in range(0, len(codes), BLOCK):
            stop = min(start + BLOCK, len(codes))
            logs = self.log_ends(self.vocabulary.ends(codes, start, stop))
            known = len(held)
            held = np.concatenate([held, np.empty((stop - start, held.shape[1]))])
            for b in range(stop - start):
                n = min(reach, known + b)
                ways = held[known + b - n : known + b][::-1] + logs[b, :n]
                top = ways.max(0)
                held[known + b] = top + np.log(np.exp(ways - top).sum(0))
            if not keep:
                held = held[-reach:]
        return held

    def long_score(self, codes: np.ndarray) -> np.ndarray:
        return self.log_forward(codes, keep=False)[-1]

    def long_expected(self, codes: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> None:
        """Add the expected uses of every piece in one long word to ``totals``."""
        length, reach = len(codes), self.vocabulary.reach
        alpha = self.log_forward(codes, keep=True)
        beta = np.full((length + 1, len(self.languages)), -np.inf)
        beta[-1] = 0
        for stop in range(length, 0, -BLOCK):
            start = max(0, stop - BLOCK)
            ends = self.vocabulary.ends(codes, start, stop)
            logs = self.log_ends(ends)
            for b in range(stop, start, -1):  # beta of b is whole: hand it to the places before
                n = min(reach, b)
                into = beta[b - n : b][::-1]
                np.logaddexp(into, logs[b - start - 1, :n] + beta[b], out=into)
            for n in range(1, reach + 1):
                at = np.arange(max(start + 1, n), stop + 1)
                use = np.exp(alpha[at - n] + logs[at - start - 1, n - 1] + beta[at] - alpha[-1]) * counts
                for lang in range(len(self.languages)):
                    totals[:, lang] += np.bincount(ends[at - start - 1, n - 1], use[:, lang], len(totals))


def words_of(text: str) -> list[str]:
    """Runs of letters of the lower-cased text."""
    return WORD.findall(text.lower())


def train(samples: dict[str, list[str]], pieces: list[str], iterations: int = ITERATIONS) -> Model:
    languages = sorted(samples)
    model = Model(languages, pieces, np.full((len(pieces) + 1, len(languages)), 1 / (len(pieces) + 1)))
    model.probs[-1] = 0
    seen = [Counter(MARK + w for t in samples[lang] for w in words_of(t)) for lang in languages]
    words = sorted(set().union(*seen))
    counts = np.array([[c[w] for c in seen] for w in words], float).reshape(len(words), len(languages))
    for _ in range(iterations):
        uses = model.expected(words, counts)[:-1] + SMOOTHING
        model.probs[:-1] = uses / uses.sum(0)
    return model


class Scorer:
    """Scores texts with a model; remembers word scores, up to ``CACHE_WORDS``."""

    def __init__(self, model: Model):
        self.model, self.index = model, {}
        self.scores = np.empty((0, len(model.languages)))

    def _lookup(self, words: list[str]) -> np.ndarray:
        long = [i for i, w in enumerate(words) if len(w) >= LONG]  # with its mark, over LONG
        if not long:
            return self._remembered(words)
        out = np.empty((len(words), len(self.model.languages)))
        short = np.ones(len(words), bool)
        short[long] = False
        out[short] = self._remembered([w for w in words if len(w) < LONG])
        for i in long:  # not remembered, since they may be of any length
            out[i] = self.model.word_scores([MARK + words[i]])[0]
        return out

    def _remembered(self, words: list[str]) -> np.ndarray:
        if len(self.index) > CACHE_WORDS:
            self.index, self.scores = {}, self.scores[:0]
        fresh = [w for w in dict.fromkeys(words) if w not in self.index]
        if fresh:
            self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))
            self.scores = np.concatenate([self.scores, self.model.word_scores([MARK + w for w in fresh])])
        return self.scores[np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text, looked up in groups of texts; a long text
        is summed block by block."""
        totals = np.zeros((len(texts), len(self.model.languages)))
        counts = np.zeros(len(texts), np.int64)
        words, owners = [], []

        def flush() -> None:
            if words:
                scores = self._lookup(words)
                begins = np.cumsum([0] + [n for _, n in owners[:-1]])
                totals[[o for o, _ in owners]] += np.add.reduceat(scores, begins)
            words.clear(), owners.clear()

        for i, t in enumerate(texts):
            parts = words_of(t or "")
            counts[i] = len(parts)
            for a in range(0, len(parts), GROUP_WORDS):
                block = parts[a : a + GROUP_WORDS]
                words += block
                owners.append((i, len(block)))
                if len(words) >= GROUP_WORDS:
                    flush()
        flush()
        best, known = totals.argmax(1), counts > 0
        score = 1 / np.exp(totals - totals.max(1, keepdims=True)).sum(1)
        return [self.model.languages[b] if k else "und" for b, k in zip(best, known)], np.where(known, score, 0.0)


def labelled_sample(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, list[str]]:
    """Texts by language: not held out, lowest hashes of the id first, up to ``rows`` ids and
    until their texts reach ``chars`` characters."""
    known = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.length(text_col).alias("n"))
    known = known.filter(F.col("lang").isNotNull() & (F.col("n") > 0) & ~held_out("id")).withColumn("h", F.xxhash64("id"))
    # A language with most of the rows is cut bucket by bucket; rows of one id share a rank.
    order = [F.col("h"), F.col("id")]
    near = F.dense_rank().over(W.partitionBy("lang", F.pmod("h", F.lit(ID_BUCKETS))).orderBy(*order))
    first = known.withColumn("near", near).filter(F.col("near") <= rows).groupBy("lang", "h", "id").agg(F.max("n").alias("n"))
    by_hash = W.partitionBy("lang").orderBy(*order)  # at most rows x ID_BUCKETS ids a language
    before = F.sum("n").over(by_hash.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")
    ids = first.withColumns({"first": F.row_number().over(by_hash), "before": before})
    ids = ids.filter((F.col("first") <= rows) & (F.col("before") < chars)).select("id", "lang")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    texts = texts.filter(F.length("text") > 0).join(F.broadcast(ids), ["id", "lang"]).groupBy("lang", "id").agg(F.min("text").alias("text"))
    found: dict[str, list[str]] = {}
    # Bounded: one text an id, ``rows`` ids and ``chars`` characters and a text a language.
    for r in texts.orderBy("lang", "id").collect():
        found.setdefault(r["lang"], []).append(r["text"])
    return found


def with_language(spark: SparkSession, docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score as further columns."""
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    # A few MB: pieces of the public vocabulary times languages.
    shared = spark.sparkContext.broadcast((model.languages, model.pieces, model.probs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value))
        for b in batches:
            langs, scores = scorer.predict(b.column(text_col).to_pylist())
            yield with_columns(b, {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores)})

    schema = docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)}).schema
    return docs.mapInArrow(lean(run), schema)


def fit(docs: DataFrame, vocabulary: str | None = None, **columns: str) -> Model | None:
    """Model from the sample of ``docs``; None if no row can be learned from."""
    sample = labelled_sample(docs, **columns)
    return train(sample, read_pieces(vocabulary or default_vocabulary())) if sample else None
