"""Token ids of whole texts under a byte-level BPE vocabulary, with a memory of words.

The vocabulary file is a ``tokenizers`` JSON; its merges are in the order of their
ids, so the same ids come from ``tiktoken`` with the ids as ranks, three times as
fast (the tests compare both libraries). The usual pattern never joins characters
across a single blank between two characters that are not white space: texts are cut
there and every distinct word is encoded once and remembered.

White space of any length is encoded: long runs are cut out by the pattern's own rule
before the pattern sees them.

The added tokens of the file (``<|endoftext|>``) are matched inside a text as the
library does by default: the text is split at them, they give their own ids, and the
parts between are encoded as separate texts.
"""

from __future__ import annotations

import json
import re
import sys
from array import array

CACHE_WORDS = 100_000
#: White space beside a blank, or a blank at an end: the text is cut with more care.
_ODD = re.compile(r"\s | \s|\A | \Z")
_BLANK = re.compile(r"(?<=\S) (?=\S)")
#: Fixed value: the white space of that pattern.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: White space from this length on does not go through the pattern, which needs stack for each
#: character of it (about a million end the process).
LONG_RUN = 1000
_LONG_RUN = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")
#: Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in such a file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def read_encoding(path: str):
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    byte_of = _byte_of()
    ranks = {bytes(byte_of[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def read_added(path: str) -> dict[str, int]:
    """Ids of the added tokens, which match anywhere in a text, the longest first."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that look at the text around them are not supported")
    return {t["content"]: t["id"] for t in sorted(added, key=lambda t: -len(t["content"]))}


def cut_at_blanks(text: str) -> tuple[str, list[str]]:
    """The text up to the first cut, and the pieces after it without their blanks."""
    if _ODD.search(text) is None:
        first, *rest = text.split(" ")
        return first, rest
    cuts = [m.start() for m in _BLANK.finditer(text)]
    pieces = [text[a + 1 : b] for a, b in zip(cuts, [*cuts[1:], len(text)])]
    return text[: cuts[0] if cuts else len(text)], pieces


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def encode_with_runs(encoding, text: str) -> list[int]:
    """Ids of a text with white space of any length. The pattern makes one piece of such a run,
    without its last character if more text follows, which begins the next piece; nothing
    before or behind a run depends on it."""
    out, at = [], 0
    for run in _LONG_RUN.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        out += encoding.encode_ordinary(text[at : run.start()])
        out += encoding._encode_single_piece(text[run.start() : stop])
        at = stop
    return out + encoding.encode_ordinary(text[at:])


class WordEncoder:
    """Packed ids of texts without added tokens (their characters are encoded like any
    others); remembers up to ``cache_words`` words."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        encoding = read_encoding(path)
        ordinary = encoding.encode_ordinary
        self.encode_word = lambda text: ordinary(text) if len(text) < LONG_RUN else encode_with_runs(encoding, text)
        self.limit = cache_words
        self.words: dict[str, bytes] = {}  # a piece without its blank -> ids

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._encode(*cut_at_blanks(t)) for t in texts]

    def _encode(self, first: str, rest: list[str]) -> bytes:
        words, out = self.words, [pack_ids(self.encode_word(first))]
        for w in rest:
            ids = words.get(w)
            if ids is None:
                ids = pack_ids(self.encode_word(" " + w))
                if len(words) < self.limit:  # the frequent ones come early
                    words[w] = ids
            out.append(ids)
        return b"".join(out)


class TextEncoder:
    """Packed ids of texts, added tokens included, as the ``tokenizers`` library gives them."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.parts = WordEncoder(path, cache_words)
        self.added = {t: pack_ids([i]) for t, i in read_added(path).items()}
        self.split = re.compile("(" + "|".join(map(re.escape, self.added)) + ")").split

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._encode(t) if any(a in t for a in self.added) else self.parts.encode([t])[0] for t in texts]

    def _encode(self, text: str) -> bytes:
        """Every second part of the split is an added token."""
        split = self.split(text)
        between = self.parts.encode(split[::2])
        return b"".join([between[0], *[self.added[a] + b for a, b in zip(split[1::2], between[1:])]])
