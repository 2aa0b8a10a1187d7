"""Chat formatting in budgeted windows.

The turns of a conversation, in order, are cut into turn-aligned windows by prefix
sums of their token counts (ids of the text in a public byte-level vocabulary, and four
for the marks of the turn): a window holds the next turns whose sum fits the budget,
behind the conversation's system turn (if it opens with one, of whatever length) and
the last turns of the window before, as far as the history budget goes and the first
new turn leaves room. A window is over the budget only if the system turn and one new
turn are; it then holds these two alone. Repeated turns are marked and carry no loss,
so every assistant text is a target exactly once.

Template: ``<s>``, then per turn ``[role]`` + text + ``[/role]`` (repeated turns:
``[=role]``), then ``</s>``. In texts and roles the characters ``\\``, ``<`` and
``[`` are written ``\\\\``, ``\\l`` and ``\\b``; no control string can therefore
appear in them, and the way back is exact.

Conversations stream through a task in sorted order; memory holds one window (and
one turn) at a time, however long a conversation is. NULL texts and roles are empty;
turns with the same number are ordered by role, then text; repeated rows stay
repeated turns; NULL turn numbers come first; rows of a NULL id form one
conversation. Columns other than the four are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinepulse.llm.tokens import TextEncoder, default_vocabulary

WINDOWS = "conv_id long, window long, formatted string, mask array<struct<start: bigint, stop: bigint>>, tokens long"
READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
CODES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
DECODES = {v: k for k, v in CODES.items()}
TURN = re.compile(r"\[(=?)([^\]]*)\](.*?)\[/\2\]", re.S)
MARK_TOKENS = 4
ROWS_PER_BATCH = 500
CHARS_PER_BATCH = 4_000_000


def escape(text: str, role: bool = False) -> str:
    out = re.sub(r"[\\<\[]", lambda m: CODES[m[0]], text)
    return out.replace("]", "\\e").replace("=", "\\q") if role else out


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lbeq]", lambda m: {"\\e": "]", "\\q": "="}.get(m[0]) or DECODES[m[0]], text)


@functools.lru_cache(maxsize=1)
def _encoder(vocabulary: str) -> TextEncoder:
    """One for all tasks of a worker process."""
    return TextEncoder(vocabulary)


def count_tokens(text: str, vocabulary: str | None = None) -> int:
    """Tokens of a turn: the ids of its text, and four for its marks."""
    (ids,) = _encoder(vocabulary or default_vocabulary()).encode([text])
    return len(ids) // 4 + MARK_TOKENS


def _last_within(turns: list[tuple[str, str, int]], budget: int) -> list[tuple[str, str, int]]:
    """The longest end of ``turns`` with at most ``budget`` tokens: the first prefix sum
    that leaves no more, by bisection."""
    sums = [0, *accumulate(t[2] for t in turns)]
    return turns[bisect_left(sums, sums[-1] - budget) :] if budget > 0 else []


def render(turns: list[tuple[str, str]], repeated: int) -> tuple[str, list[dict]]:
    """Formatted window and its loss mask; the first ``repeated`` turns carry no loss."""
    out, at, mask = ["<s>"], 3, []
    for i, (role, text) in enumerate(turns):
        name = escape(role, role=True)
        head, body, tail = f"[{'=' if i < repeated else ''}{name}]", escape(text), f"[/{name}]"
        if role == "assistant" and i >= repeated:
            mask.append({"start": at + len(head), "stop": at + len(head) + len(body)})
        out += [head, body, tail]
        at += len(head) + len(body) + len(tail)
    return "".join([*out, "</s>"]), mask


class _Windows:
    """Windows of one conversation, fed turn by turn."""

    def __init__(self, budget: int, history: int, vocabulary: str | None = None):
        self.budget, self.history_budget, self.vocabulary = budget, history, vocabulary
        self.system: list[tuple[str, str, int]] = []
        self.history: list[tuple[str, str, int]] = []
        self.new: list[tuple[str, str, int]] = []
        self.sum, self.n, self.turns = 0, 0, 0

    def close(self) -> tuple | None:
        if not self.new:
            return None
        ahead = [*self.system, *self.history] if self.n else []
        formatted, mask = render([t[:2] for t in [*ahead, *self.new]], len(ahead))
        out = (self.n, formatted, mask, sum(t[2] for t in ahead) + self.sum)
        first_turns = self.n == 0 and bool(self.system)
        self.history = _last_within(self.new[1 if first_turns else 0 :], self.history_budget)
        self.new, self.sum, self.n = [], 0, self.n + 1
        return out

    def _make_room(self, size: int) -> None:
        """Drops the oldest history that does not fit beside the first new turn."""
        self.history = _last_within(self.history, self.budget - size - sum(t[2] for t in self.system))

    def add(self, role: str, text: str) -> tuple | None:
        size = count_tokens(text, self.vocabulary)
        ahead = sum(t[2] for t in [*self.system, *self.history]) if self.n else 0
        out = self.close() if self.new and ahead + self.sum + size > self.budget else None
        if self.turns == 0 and role == "system":
            self.system = [(role, text, size)]
        if self.n and not self.new:
            self._make_room(size)
        self.new.append((role, text, size))
        self.sum += size
        self.turns += 1
        return out


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight=lambda r: 1) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += weight(r)
        if len(held) >= ROWS_PER_BATCH or size >= CHARS_PER_BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def format_windows(turns: DataFrame, budget: int = 512, history: int = 96, vocabulary: str | None = None) -> DataFrame:
    """Windows of conversations (conv_id, turn, role, text), in order within a task.

    ``budget`` and ``history`` count tokens (``count_tokens``) of a window and of the
    repeated turns in it, the system turn aside; ``vocabulary`` is the path of the
    public vocabulary, the same on every executor."""
    vocabulary = vocabulary or default_vocabulary()
    out = pa.schema(
        [("conv_id", pa.int64()), ("window", pa.int64()), ("formatted", pa.string()), ("mask", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("tokens", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows() -> Iterator[tuple]:
            current, conv = object(), None
            for b in batches:
                for cid, role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                    if cid != current:
                        if conv and (w := conv.close()):
                            yield (current, *w)
                        current, conv = cid, _Windows(budget, history, vocabulary)
                    if w := conv.add(role, text):
                        yield (cid, *w)
            if conv and (w := conv.close()):
                yield (current, *w)

        yield from _batches(windows(), out, weight=lambda r: len(r[2]))

    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, WINDOWS)


def parse_window(formatted: str) -> list[tuple[str, str, bool]]:
    """(role, text, repeated) of every turn of a formatted window."""
    if not (formatted.startswith("<s>") and formatted.endswith("</s>")):
        raise ValueError("not a formatted window")
    return [(unescape(m[2]), unescape(m[3]), bool(m[1])) for m in TURN.finditer(formatted, 3, len(formatted) - 4)]


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text and the mask alone: its turns, each
    once, and the text under the loss mask. Takes the frame of ``format_windows`` (its
    windows are in order within a task)."""
    out = pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n in (c.split()[0] for c in READ_BACK.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations() -> Iterator[tuple]:
            current, state = object(), None

            def done() -> tuple:
                n, turns, chars, loss, total, k = state
                return (current, n, turns.hexdigest(), chars, loss.hexdigest(), total, k)

            for b in batches:
                for cid, formatted, mask in zip(*(b.column(i).to_pylist() for i in range(3))):
                    if cid != current:
                        if state:
                            yield done()
                        current, state = cid, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                    for role, text, repeated in parse_window(formatted):
                        if not repeated:
                            state[0] += 1
                            state[1].update(f"{role}\n{text}\n".encode())
                    for m in mask:
                        target = unescape(formatted[m["start"] : m["stop"]])
                        state[2] += len(target)
                        state[3].update(target.encode())
                    state[4] += len(formatted)
                    state[5] += 1
            if state:
                yield done()

        yield from _batches(conversations(), out)

    return windows.select("conv_id", "formatted", "mask").mapInArrow(run, READ_BACK)
