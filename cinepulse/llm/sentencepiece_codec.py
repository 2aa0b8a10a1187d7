"""SentencePiece models on the ``tokenizers`` library: encoding and decoding.

The model file (a protobuf) is read field by field: pieces with scores and kinds, the
algorithm, and the normaliser's settings. From these a ``tokenizers`` tokenizer is
rebuilt: the precompiled character map, blank handling, the marker for blanks,
unigram scores (or, for a BPE model, merges in the order of the scores), byte
fallback and the decoder. Batches are encoded by the library's threads.

Texts are cut before each run of blanks (literal markers U+2581 in or behind it are
part of the run, and a blank behind a literal marker is no cut) and, under a BPE model with
byte fallback whose pieces hold no line break, before each run of line breaks: no piece
could cross the cut. Every distinct word is encoded, decoded and remembered; under
such a model new words stand in one text for this, a line break between them. ``parity``
compares with the original library: every whole text that holds a literal marker, and
every distinct word of the others once. Of these, a BPE model without a normaliser
merges each word alone, whatever stands around it; under any other model every whole
text is compared. Ids that differ from the original's are reported (``parity`` false),
never silently replaced.

NULL is the empty text (no ids). A decoded text has what the normaliser made of the
input, with a marker character in it read as a blank; otherwise, for the registered
model, that is the text itself. Repeated rows, empty
tables and other columns need nothing special: the operator is a map.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinepulse.llm.common import lean, with_columns
from cinepulse.llm.tokens import pack_ids

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
#: A blank that starts a run of markers.
_RUN = re.compile(rf"(?<![ {MARK}]) ")
#: Blanks and the word behind them, or blanks at the end.
_WORD = re.compile(" *[^ ]+| +")
#: The same, cut before line breaks too.
_LINE_WORD = re.compile("\n* *[^ \n]+| +|\n+")
JOINED_WORDS = 100  # new words that stand in one text
CACHE_WORDS = 500_000  # about 200 bytes each
KEPT_CHARS = 200  # longer stretches are not remembered beyond their batch once the memory is full
ENCODED = "ids binary, n_tokens long, decoded string, parity boolean"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# --- the protobuf -----------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a message: numbers for varints, bytes for the rest."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return out

    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(wire) or varint()
        yield number, data[at : at + size]
        at += size


@dataclass
class ModelProto:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    algorithm: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> ModelProto:
        out = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                out.pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                out.algorithm, out.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                out.charsmap = spec.get(2, b"")
                out.dummy_prefix, out.remove_extra, out.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        return out

    @property
    def unknown_id(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Merges of a BPE model: every split of a piece in two pieces, best score first."""
    known = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, i in known.items():
        splits = [(piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in known and piece[k:] in known]
        found += [(-pieces[i][1], known[a], known[b], a, b) for a, b in splits]
    return [(a, b) for *_, a, b in sorted(found)]


def rebuild(proto: ModelProto):
    """The ``tokenizers`` tokenizer without the dummy prefix (the codec adds it)."""
    from tokenizers import Tokenizer, decoders, models, normalizers

    unknown = proto.pieces[proto.unknown_id][0]
    if proto.algorithm == BPE:
        vocabulary = {p: i for i, (p, _, _) in enumerate(proto.pieces)}
        model = models.BPE(vocabulary, merges(proto.pieces), unk_token=unknown, fuse_unk=True, byte_fallback=proto.byte_fallback)
    elif proto.algorithm == UNIGRAM:
        # Control pieces never match a text: their names get a blank, which no
        # normalised text contains. (A text that spells a byte piece fails parity.)
        scored = [(p if kind in (NORMAL, USER_DEFINED, BYTE) else " " + p, s) for p, s, kind in proto.pieces]
        model = models.Unigram(scored, proto.unknown_id, proto.byte_fallback)
    else:
        raise ValueError(f"algorithm {proto.algorithm} is not supported")
    out = Tokenizer(model)
    if proto.escape:
        out.normalizer = normalizers.Replace(" ", MARK)
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return out


# --- the codec --------------------------------------------------------------------


class Codec:
    """Encodes and decodes texts word by word, remembering words."""

    def __init__(self, path: str, threads: int | None = None, cache_words: int = CACHE_WORDS):
        if threads:
            os.environ["RAYON_NUM_THREADS"] = str(threads)
            os.environ["TOKENIZERS_PARALLELISM"] = str(threads > 1).lower()
        import sentencepiece
        from tokenizers import normalizers

        with open(path, "rb") as f:
            data = f.read()
        self.proto = ModelProto.parse(data)
        self.tokenizer = rebuild(self.proto)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.charsmap = normalizers.Precompiled(self.proto.charsmap) if self.proto.charsmap else None
        # A cut before a blank is safe if no piece has a blank behind another character.
        self.cuts = all(MARK not in p.lstrip(MARK) for p, _, kind in self.proto.pieces if kind in (NORMAL, USER_DEFINED))
        # Words alone show that the ids of their text are the original's.
        self.by_word = self.cuts and self.proto.algorithm == BPE and self.proto.escape and not self.proto.remove_extra and not self.charsmap
        # Line breaks keep words apart if they are bytes alone, in no piece.
        self.lines = self.by_word and self.proto.byte_fallback and not any("\n" in p for p, _, _ in self.proto.pieces)
        self.words_of = (_LINE_WORD if self.lines else _WORD).findall
        self.limit = cache_words
        self.lead = len(self.original.encode("\n"))
        self.words: dict[str, bytes] = {}  # packed ids
        self.odd: dict[str, tuple[str, bool]] = {}  # decoded text and parity, unless the word itself and true
        self.again: set[str] = set()  # words that came again after the batch that brought them

    def normalise(self, text: str) -> str:
        """What is encoded: blanks are still blanks."""
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if self.proto.remove_extra:
            text = " ".join(w for w in text.split(" ") if w)
        return " " + text if text and self.proto.dummy_prefix else text

    def cut(self, text: str) -> list[str]:
        """Words with the run of blanks before them; blanks at the end stay one word."""
        if not self.cuts:
            return [text] if text else []
        if MARK in text:
            at = [0, *[m.start() for m in _RUN.finditer(text)], len(text)]
            return [text[a:b] for a, b in pairwise(at) if a < b]
        if self.lines and "  " not in text and "\0" not in text:  # as below, but for runs of line breaks
            words = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
            return words if words[0] else words[1:]
        return self.words_of(text)

    def _learn_joined(self, words: list[str]) -> list[str]:
        """Ids of distinct words, many in one text with a line break before each. The words of a
        text are learned if all its ids are the original's of each word alone and decode to
        it; the others are returned."""
        lines, starts = ["\n" + w for w in words], range(0, len(words), JOINED_WORDS)
        texts = ["".join(lines[i : i + JOINED_WORDS]) for i in starts]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        decoded = self.tokenizer.decode_batch(found, skip_special_tokens=False)
        expected = self.original.encode(lines, num_threads=1)
        left, lead = [], self.lead
        for i, text, ids, t in zip(starts, texts, found, decoded):
            some, want = words[i : i + JOINED_WORDS], [e[lead - 1 :] for e in expected[i : i + JOINED_WORDS]]
            if ids != list(chain.from_iterable(want)) or t != text.replace(MARK, " "):
                left += some
                continue
            packed, ends = pack_ids(ids), list(accumulate(map(len, want), initial=0))
            self.words.update((w, packed[4 * a + 4 : 4 * b]) for w, a, b in zip(some, ends, ends[1:]))
            if MARK in text:
                self.odd.update((w, (w.replace(MARK, " "), True)) for w in some if MARK in w)
        return left

    def _learn(self, words: list[str]) -> None:
        """Ids of distinct words, each decoded again and checked against the original library
        if that shows anything for their texts.

        The original adds its prefix to every text; behind a line break, which no
        piece holds together with anything else, a word stands as inside a text."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        texts = self.tokenizer.decode_batch(found, skip_special_tokens=False)
        expected = found
        if self.by_word:
            expected = [ids[self.lead :] for ids in self.original.encode(["\n" + w for w in words], num_threads=1)]
        packed, ends = pack_ids(list(chain.from_iterable(found))), list(accumulate(map(len, found), initial=0))
        self.words.update((w, packed[4 * a : 4 * b]) for w, a, b in zip(words, ends, ends[1:]))
        for w, ids, t, want in zip(words, found, texts, expected):
            if t != w or ids != want:
                self.odd[w] = t, ids == want and t == w.replace(MARK, " ")

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str, bool]]:
        """(packed ids, decoded text, parity) of each text."""
        plain = [self.normalise(t or "") for t in texts]
        cut = [self.cut(t) for t in plain]
        used = set().union(*cut)
        fresh = list(used.difference(self.words))
        for i in range(0, len(fresh), 10_000):
            new = fresh[i : i + 10_000]
            if self.lines:
                new = self._learn_joined(new)
            if new:
                self._learn(new)
        used.difference_update(fresh)
        self.again |= used
        out = []
        strip = 1 if self.proto.dummy_prefix else 0
        ids, odd = self.words.__getitem__, self.odd
        for words in cut:
            text, parity = "".join(words), True  # what the words of the text decode to, but for odd ones
            if odd and not odd.keys().isdisjoint(words):
                text = "".join([odd[w][0] if w in odd else w for w in words])
                parity = all(odd[w][1] for w in words if w in odd)
            out.append((b"".join(map(ids, words)), text[strip:], parity))
        if len(self.words) > self.limit:  # the frequent ones came again, or are among those just used
            kept = [w for w in chain(self.again, fresh) if len(w) <= KEPT_CHARS]
            self.words = {w: ids(w) for w in kept[: self.limit // 2]}
            self.odd = {w: odd[w] for w in odd.keys() & self.words.keys()}
            self.again = set()
        whole = [i for i, t in enumerate(plain) if not self.by_word or MARK in t]
        for i, want in zip(whole, self.original.encode([texts[i] or "" for i in whole], num_threads=1)):
            out[i] = (*out[i][:2], out[i][2] and out[i][0] == pack_ids(want))
        return out


@lru_cache(1)
def _codec(path: str, threads: int) -> Codec:
    """The codec of a worker process, kept with its words from one task to the next."""
    return Codec(path, threads)


def encoded(docs: DataFrame, model: str | None = None, text_col: str = "text", threads: int = 2, rows: int = 1000) -> DataFrame:
    """``docs`` with ids (packed unsigned 32-bit), n_tokens, decoded and parity as
    further columns. ``threads``: of the library, per task."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, threads)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                b = batch.slice(at, rows)
                ids, texts, parity = zip(*codec.encode(b.column(text_col).to_pylist()))
                new = [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(texts, pa.string()), pa.array(parity)]
                yield with_columns(b, dict(zip(("ids", "n_tokens", "decoded", "parity"), new)))

    none = {c.split()[0]: F.lit(None).cast(c.split()[1]) for c in ENCODED.split(", ")}
    return docs.mapInArrow(lean(run), docs.withColumns(none).schema)
