"""Personal data: a linear-chain conditional random field over word-shape features.

Base patterns (emails, IPv4 addresses, card and phone numbers) give exact spans. A
CRF, trained by gradient descent on a small labelled table, reads the words around
and adds spans that the patterns do not cover: phone numbers without a plus, cards of
13 digits or with other marks between the digits, IPv6 addresses, addresses with
``[.]``, emails at a host without a dot or with letters outside ASCII. Base spans stay;
an added span never overlaps one.

A labelling of the CRF only becomes a span if its kind allows it (``allowed``): 7 to
15 digits in at most five groups and no letter for a phone; 13 to 19 digits that pass
Luhn for a card; a valid IPv6 address, or four parts of at most 255, for an address; one
``@`` between a name and a host with a letter for an email.

A word without a digit or an ``@`` can only have the label "none". The chain is cut
there without changing the best labelling, so only runs of the other words are
decoded, each whole, by Viterbi in numpy over all runs of one length in a batch (some
hundred bytes a word of a run); words before and after still count as context.

Offsets are code points, end exclusive. NULL is the empty text; whole texts are
read, whatever their length; repeated rows are handled alike; an empty table gives
an empty result; columns other than the text are passed through unread, but for those
named like the result's, which are replaced.
"""

from __future__ import annotations

import ipaddress
import random
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse.llm.common import lean, with_columns

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O", *[f"{p}-{k}" for k in KINDS for p in "BI"]]
BUCKETS = 1 << 14
MARGIN = 2.0  # by how much an added span must beat the label "none", in log odds
BATCH_WORDS = 1 << 17  # of the runs of one length that are decoded together

# --- base patterns --------------------------------------------------------------

_LOCAL = r"[A-Za-z0-9._%+-]"
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(rf"{_LOCAL}+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(?:(\.[0-9]+)(\.[0-9]+)(\.[0-9]+))?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARKS = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` outwards: linear also in long runs."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _AT.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", m.end() if m else at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip(".").lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    if not _MARKS.search(text):
        return []
    out = [(a, b, 0) for a, b in _emails(text)]
    for m in _IP.finditer(text):  # runs of digits are consumed whole, matched or not
        if m[1] and all(map(_small, m[0].split("."))):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), 3))
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda s: (s[0], s[2], s[1]))]


# --- words and features -----------------------------------------------------------

_OPEN, _CLOSE = "([{<\"'|*#$%&!", ")]}>\"'|*#$%&!.,;:?"


def _word_at(text: str, at: int) -> tuple[int, int]:
    a = b = at
    while a > 0 and not text[a - 1].isspace():
        a -= 1
    while b < len(text) and not text[b].isspace():
        b += 1
    return a, b


def runs(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring words that hold a digit or an ``@``, as (start, end)."""
    out: list[list[tuple[int, int]]] = []
    m = _MARKS.search(text)
    while m:
        a, b = _word_at(text, m.start())
        if out and not text[out[-1][-1][1] : a].strip():
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
        m = _MARKS.search(text, b)
    return out


def shape(word: str) -> str:
    """Digits as 9, letters as a or A in runs of one."""
    return re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() else "a", re.sub(r"[0-9]", "9", word))


def _plain(word: str) -> str:
    return re.sub(r"\W", "", word.lower())


def words_before(text: str, at: int, n: int = 3) -> list[str]:
    """Up to ``n`` whole words before a place, the nearest first."""
    size = 64
    while True:
        near = text[max(0, at - size) : at]
        words = near.split()
        if size >= at or len(words) > n:  # the first word of the window may be cut
            return [_plain(w) for w in words[: -n - 1 : -1]]
        if len(words) > 1 and size >= 1024:  # far from the place: fewer words, but whole ones
            return [_plain(w) for w in words[:0:-1]]
        size *= 4


_NEXT = re.compile(r"\s*(\S*)")
_HEXES = re.compile(r"[0-9A-Fa-f:]+")


def word_features(text: str, run: list[tuple[int, int]]) -> list[list[int]]:
    words = [text[a:b].strip(_OPEN + _CLOSE.replace(".", "") + ".,;:") or text[a:b] for a, b in run]
    shapes = [shape(w) for w in words]
    shorts = [re.sub("9+", "9", s) for s in shapes]
    near = words_before(text, run[0][0])
    before, after = near[0] if near else "", _plain(_NEXT.match(text, run[-1][1])[1])
    length = f"run={min(len(run), 6)}/{min(sum(sum(map(str.isdigit, w)) for w in words), 20)}"
    out = []
    for i, (w, s, short) in enumerate(zip(words, shapes, shorts)):
        digits, place = sum(map(str.isdigit, w)), min(i, 6)
        names = [
            "bias",
            f"shape={s}",
            f"short={short}",
            f"digits={min(digits, 17)}",
            f"at={'@' in w}/{w[:1] == '@'}",
            f"dots={min(w.count('.'), 4)}",
            f"colons={min(w.count(':'), 8)}/{'::' in w}/{_HEXES.fullmatch(w) is not None}",
            f"letters={any(map(str.isalpha, w))}",
            f"first={text[run[i][0]]}" if text[run[i][0]] in "+(" else "first=other",
            f"last={shapes[i - 1]}" if i else f"before={before}",
            f"next={shapes[i + 1]}" if i + 1 < len(run) else f"after={after}",
            f"{length}/{place}",
            f"{length}/{place}/{s}",
            *[f"near={x}/{place}" for x in near],
            *[f"near={x}/{short}" for x in near],
        ]
        out.append([zlib.crc32(n.encode()) % BUCKETS for n in names])
    return out


# --- the labelled table -----------------------------------------------------------

# A sentence is an opening, a form and an end; in forms # is a random digit and x a random
# hexadecimal one. Of the many combinations a seeded draw takes a few thousand; a
# quarter of all combinations, by their hash, is held out of the training table.

_OPENINGS = {
    "phone": "my phone is|call me at|reach me on|tel|tel.|telephone:|his mobile|her cell is|phone:|please call|fax|ring me on|contact number|dial|"
    "text me at|whatsapp|the hotline|you can call|mobile number|office phone|my number is|call us at|phone number:|call",
    "card": "card|visa|my card number is|paid with card|credit card:|mastercard|charge card|debit card|the card ending|card no.",
    "ip": "server|host|requests from|address|ping|gateway|connect to|blocked|the ip|router at|login from",
    "email": "mail|write to|contact|email|e-mail:|reach us at|send it to|address:|message|from",
    "none": "in|see pages|years|the sum of|prices were|version|section|isbn|order|score|lot|values|data:|temperatures|rows|id|invoice|on|from|"
    "between|size|about|chapter|room|table|figures|we sold|results|token =|flight|bus|at|it costs|count|serial|built in|numbers|the|",
}
_FORMS = {
    "phone": "###-###-####|(###) ###-####|###.###.####|### ### ####|0## #######|0### ######|0## ### ## ##|0# ## ## ## ##|###-####|(0##) ########|"
    "#-###-###-####|00## ## #######|0###/######|(###)###-####|### #######|##########|0##-#######|### ####",
    "card": "####.####.####.####|#############|####/####/####/####|####_####_####_####|####  ####  ####  ####|####.######.#####",
    "ip": "2001:db8:xxxx::##|fe80::xxx:b#ff:fe##:c###|20##:0db8:85a3:0000:0000:8a2e:0###:7xx#|1#[.]2#[.]1##[.]#|##(.)#(.)1##(.)##|fd##:xxxx:#::1|::ffff:xx#:#x",
    "email": "ann##@localhost|josé##@example.com|user@mailhost|bob.lee@intranet|jörg@example.de|x##@[10.#.1#.#]|ops-##@node#|zoë.m@exämple.org",
    "none": "####|#### ####|#### #### ####|##|###|## and ###|#.#.#|#.##|##.##|$##.##|##%|#,###,###|####-0#-1#|1#:##|1#:##:##|##/##/####|###-#-##-######-#|"
    "########|##########|###########|###-####|### ####|############|#################|x#x#x#x#x#x#x#x#x#|ab###|@user##|@team|# @ $#.##|### ### ###|##-##|##.##.####|#x#|# of ##|##th|"
    "{#}|{##}|{###}|{####}|{19##}|{20##}|{0.##}|{#.##}|{##.#}|{-#.#}|{$#.##}|{#,###}|{#/#}|{1#:##}|{####-0#-1#}|{#####}|{######}",
}
_ENDS = "||.|today|before noon|, thanks|any time|or come by|if it rains|and ask for ann|after six|please|in all|for the report|were found|!|to be sure"
#: Openings of phone numbers before numbers that are none.
_DECOYS = "call # of ## people|phone ## pro|the phone costs ###|call ## times|tel aviv ####|fax it in ####|mobile sales of #,### and #,###|dial # or #|my number is #|" \
    "card ## of ###|card game of ####|visa for ## days|host ## guests|mail ## letters|server ## of ##|call {20##}|phone {0.##}|tel {#}|numbers to call {##}"


def allowed(span: str, kind: str) -> bool:
    """Whether a labelled span is one that its kind allows."""
    digits = "".join(c for c in span if c in "0123456789")
    if kind == "phone":
        groups = re.findall("[0-9]+", span)
        return 7 <= len(digits) <= 15 and len(groups) <= 5 and not any(map(str.isalpha, span)) and "@" not in span and ":" not in span
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not any(map(str.isalpha, span))
    if kind == "email":
        name, _, host = span.partition("@")
        return any(map(str.isalnum, name)) and "@" not in host and (any(map(str.isalpha, host)) or host[:1] == "[")
    parts = re.split(r"\[\.\]|\(\.\)", span)
    if len(parts) == 4:
        return all(p.isascii() and p.isdigit() and _small(p) for p in parts)
    try:
        return ipaddress.ip_address(span).version == 6
    except ValueError:
        return False


def _filled(form: str, kind: str, rng: random.Random) -> str:
    form = re.sub(r"\{(.*?)\}", lambda m: " ".join([m[1]] * rng.randrange(3, 14)), form)  # a list
    hexed = kind == "ip" or form.startswith("x#")
    out = "".join(rng.choice("0123456789") if c == "#" else rng.choice("0123456789abcdef") if c == "x" and hexed else c for c in form)
    while kind == "card" and not luhn(re.sub("[^0-9]", "", out)):
        out = out[:-1] + str((int(out[-1]) + 1) % 10)
    return out


def labelled_table(sentences: int = 2400, seed: int = 11, held: bool = False) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """The labelled table: (text, spans). ``held`` draws from the sentences held out of training."""
    rng, ends, out = random.Random(seed), _ENDS.split("|"), []
    decoys = _DECOYS.split("|")
    while len(out) < sentences:
        kind = rng.choices([*KINDS, "none", "decoy"], [1, 1, 1, 4, 5, 1])[0]
        opening = "" if kind == "decoy" else rng.choice(_OPENINGS[kind].split("|"))
        form = rng.choice(decoys if kind == "decoy" else _FORMS[kind].split("|"))
        end = rng.choice(ends)
        if (zlib.crc32(f"{opening}|{form}|{end}".encode()) % 4 == 0) != held:
            continue
        form = _filled(form, kind, rng)
        text = f"{opening} " if opening else ""
        spans = [(len(text), len(text) + len(form), kind)] if kind in KINDS and allowed(form, kind) else []
        if kind not in KINDS or spans:
            out.append((text + form + ("" if end[:1] in ".,!" else " ") + end, spans))
    return out


# --- the model --------------------------------------------------------------------


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


@dataclass
class Crf:
    emit: np.ndarray  # BUCKETS x labels
    step: np.ndarray  # labels x labels, from row to column
    start: np.ndarray

    def potentials(self, feats: list[list[int]]) -> np.ndarray:
        return np.stack([self.emit[f].sum(0) for f in feats])

    def emissions(self, text: str, run: list[tuple[int, int]]) -> np.ndarray:
        return self.potentials(word_features(text, run))

    def viterbi(self, node: np.ndarray) -> np.ndarray:
        """Best labels of a batch of runs of one length: node is runs x words x labels."""
        best, back = node[:, 0] + self.start, []
        for t in range(1, node.shape[1]):
            scores = best[:, :, None] + self.step[None]
            back.append(scores.argmax(1).astype(np.int8))
            best = scores.max(1) + node[:, t]
        path = [best.argmax(1)]
        for b in reversed(back):
            path.append(b[np.arange(len(b)), path[-1]])
        return np.stack(path[::-1], 1)

    def gradient(self, node: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected minus observed counts of one run: (node, step, start)."""
        n, k = node.shape
        alpha, beta = np.empty((n, k)), np.zeros((n, k))
        alpha[0] = node[0] + self.start
        for t in range(1, n):
            alpha[t] = _lse(alpha[t - 1][:, None] + self.step, 0) + node[t]
        for t in range(n - 2, -1, -1):
            beta[t] = _lse(self.step + (node[t + 1] + beta[t + 1])[None], 1)
        total = _lse(alpha[-1], 0)
        marginal = np.exp(alpha + beta - total)
        pairs = np.zeros((k, k))
        for t in range(1, n):
            pairs += np.exp(alpha[t - 1][:, None] + self.step + (node[t] + beta[t])[None] - total)
            pairs[gold[t - 1], gold[t]] -= 1
        first = marginal[0].copy()
        first[gold[0]] -= 1
        marginal[np.arange(n), gold] -= 1
        return marginal, pairs, first


def forbidden_steps() -> np.ndarray:
    """-30 where a label cannot follow: an I only after the B or I of its kind."""
    out = np.zeros((len(LABELS), len(LABELS)))
    for j, to in enumerate(LABELS):
        if to[0] == "I":
            for i, of in enumerate(LABELS):
                out[i, j] = 0 if of[2:] == to[2:] and of != "O" else -30
    return out


def train(table: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = 10, rate: float = 0.15, decay: float = 1e-3, seed: int = 5) -> Crf:
    """Stochastic gradient descent on the conditional log likelihood of the table's runs."""
    fixed = forbidden_steps()
    crf = Crf(np.zeros((BUCKETS, len(LABELS))), fixed.copy(), np.array([-30.0 if x[0] == "I" else 0.0 for x in LABELS]))
    data = []
    for text, spans in table:
        for run in runs(text):
            gold, last = [], None
            for a, b in run:
                hit = next(((s, k) for s, e, k in spans if a < e and b > s), None)
                gold.append(0 if hit is None else LABELS.index(("I-" if hit == last else "B-") + hit[1]))
                last = hit
            data.append((word_features(text, run), np.array(gold)))
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        pace = rate / (1 + epoch / 4)
        for i in rng.permutation(len(data)):
            feats, gold = data[i]
            node, pairs, first = crf.gradient(crf.potentials(feats), gold)
            for t, f in enumerate(feats):
                crf.emit[f] -= pace * (node[t] + decay * crf.emit[f])
            crf.step -= pace * np.where(fixed < 0, 0, pairs)
            crf.start -= pace * np.where(crf.start < -20, 0, first)
    return crf


def added_spans(texts: list[str], crf: Crf) -> list[list[tuple[int, int, str]]]:
    """Spans that the CRF finds in each text."""
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    by_length: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)
    for i, t in enumerate(texts):
        for run in runs(t):
            by_length[len(run)].append((i, run))
    for length, group in by_length.items():
        step = max(1, BATCH_WORDS // length)
        for at in range(0, len(group), step):
            part = group[at : at + step]
            node = np.stack([crf.emissions(texts[i], run) for i, run in part])
            gain = node - node[:, :, :1]
            for r, ((i, run), path) in enumerate(zip(part, crf.viterbi(node))):
                t = 0
                while t < length:
                    if path[t] == 0:
                        t += 1
                        continue
                    stop = t + 1
                    while stop < length and path[stop] and LABELS[path[stop]][0] == "I":
                        stop += 1
                    score = sum(gain[r, j, path[j]] for j in range(t, stop))
                    span = _trimmed(texts[i], run[t][0], run[stop - 1][1], LABELS[path[t]][2:])
                    if score >= MARGIN and span and allowed(texts[i][span[0] : span[1]], span[2]):
                        out[i].append(span)
                    t = stop
    return out


def _trimmed(text: str, a: int, b: int, kind: str) -> tuple[int, int, str] | None:
    opening = _OPEN.replace("(", "") if kind == "phone" else _OPEN
    while a < b and text[a] in opening:
        a += 1
    while a < b and text[b - 1] in _CLOSE:
        b -= 1
    return (a, b, kind) if a < b and _MARKS.search(text, a, b) else None


def all_spans(texts: list[str], crf: Crf) -> list[tuple[list, list]]:
    """(base spans, base and added spans by start, then kind as listed) of each text."""
    marked = [i for i, t in enumerate(texts) if _MARKS.search(t)]
    out: list[tuple[list, list]] = [([], [])] * len(texts)
    for i, more in zip(marked, added_spans([texts[i] for i in marked], crf)):
        base = base_spans(texts[i])
        taken = np.array([s[:2] for s in base] or [(0, 0)])
        free = [s for s in more if not ((taken[:, 0] < s[1]) & (taken[:, 1] > s[0])).any()]
        out[i] = (base, sorted([*base, *free], key=lambda s: (s[0], KINDS.index(s[2]), s[1])))
    return out


# --- on Spark ---------------------------------------------------------------------

SPANS = "array<struct<kind: string, start: bigint, stop: bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def fit(table: list | None = None) -> Crf:
    return train(labelled_table() if table is None else table)


def with_spans(spark: SparkSession, docs: DataFrame, crf: Crf, text_col: str = "text") -> DataFrame:
    """``docs`` with base_spans and all_spans as further columns. A map: no shuffle."""
    shared = spark.sparkContext.broadcast(crf)  # 16,384 x 9 numbers: 1.2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = all_spans([t or "" for t in b.column(text_col).to_pylist()], shared.value)
            cols = [pa.array([[{"kind": k, "start": s, "stop": e} for s, e, k in f[j]] for f in found], _SPAN_TYPE) for j in (0, 1)]
            yield with_columns(b, dict(zip(("base_spans", "all_spans"), cols)))

    schema = docs.withColumns({c: F.lit(None).cast(SPANS) for c in ("base_spans", "all_spans")}).schema
    return docs.mapInArrow(lean(run), schema)


def masked(spark: SparkSession, docs: DataFrame, crf: Crf, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``<KIND>`` (overlapping spans as one, by the first kind)."""
    shared = spark.sparkContext.broadcast(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text_col).to_pylist()
            found = all_spans([t or "" for t in texts], shared.value)
            clean = [t if not spans[1] else mask(t, spans[1]) for t, spans in zip(texts, found)]
            at = b.schema.get_field_index(text_col)
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(clean, b.column(at).type), *b.columns[at + 1 :]], names=b.schema.names)

    return docs.mapInArrow(lean(run), docs.schema)


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, end = [], 0
    for a, b, kind in spans:
        if a >= end:
            out += [text[end:a], f"<{kind.upper()}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])
