"""Chat formatting: roles of raw transcripts by a hidden Markov model.

A raw transcript is lines of text; some lines begin with a speaker marker
("User:", "### Response", "<|assistant|>", ...), many turns have none. The
states of the model are the three roles, each as the first line of a turn or
a later one. A line shows the role its marker names (if any), whether a
blank line came before, its length and how it begins and ends; given the
state these are independent. Transition and feature probabilities are
counted on conversations with known roles (with 1 added to each count), over
the whole table. Viterbi finds the most likely states; from them the turns
are rendered in one canonical form:

    <|role|>
    text of the turn, its marker taken off
    <|end|>

A conversation is worked on in segments of ``SEGMENT`` turns, so that one of
any length spreads over many tasks. A first pass gives, for each segment, the
best score from each state before it to each state at its end; these small
matrices are chained by conversation; a second pass fills in the states
between the chosen ends. The result is that of one search over everything.

Defined cases: a row without conv_id or without turn is a conversation of its
own; repeated rows count once; a null text is a turn without words; roles
other than the three count as user when learning; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import arrow_map, written

SEGMENT = 256  # turns
ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # role r: first line 2r, later lines 2r + 1
START = STATES  # before the first line

# Speaker names as transcripts write them: fixed values.
SPEAKERS = {
    "system": ("system", "sys", "context", "instructions"),
    "user": ("user", "human", "q", "question", "customer", "prompter", "instruction", "input"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "model", "agent", "gpt", "response", "output"),
}
_ROLE_OF = {name: r for r, role in enumerate(ROLES) for name in SPEAKERS[role]}
_NAMES = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
_MARKER = re.compile(
    rf"^\s*(?:<\|(?P<a>{_NAMES})\|>|\[(?P<b>{_NAMES})\]|#{{1,4}} ?(?P<c>{_NAMES}):?(?=\s|$)|\**(?P<d>{_NAMES})\** ?:\**)\s*", re.IGNORECASE
)

#: Values of each feature: marker (none or a role), blank line before, length, end, beginning.
FEATURES = (4, 2, 6, 4, 4)


def marker(line: str) -> tuple[int, int]:
    """(role number or -1, length of the marker) at the beginning of a line."""
    m = _MARKER.match(line)
    return (_ROLE_OF[m[m.lastgroup].lower()], m.end()) if m else (-1, 0)


def features(turns: list, segment: int) -> np.ndarray:
    """One row of feature values for each line of a segment's turns. Every
    turn ends with a blank line, so one comes before all segments but the first."""
    lines = [line for t in turns for line in t["lines"]]
    out = np.zeros((len(lines), len(FEATURES)), np.int64)
    blank = segment > 0
    for k, line in enumerate(lines):
        role, length = marker(line)
        text = line[length:].strip()
        end, begin = text[-1:], text[:1]
        out[k] = (
            role + 1,
            blank,
            min(5, len(text).bit_length() * 5 // 11),
            0 if not text else 1 if end in ".!" else 2 if end in "?:" else 3,
            0 if not text else 1 if begin.isupper() else 2 if begin.isalpha() else 3,
        )
        blank = not line.strip()
    return out


class Model:
    """Log-probabilities: ``step[s, t]`` from state s (START included) to t,
    ``show[f][t, v]`` of value v of feature f in state t."""

    def __init__(self, step: np.ndarray, show: list[np.ndarray]):
        norm = lambda c: np.log((c + 1) / (c + 1).sum(axis=1, keepdims=True))
        step = step.astype(float)
        self.step = norm(step)
        later = np.arange(1, STATES, 2)
        impossible = np.ones((STATES + 1, len(later)), bool)  # a later line only follows a line of its role
        for k in range(len(later)):
            impossible[[2 * k, 2 * k + 1], k] = False
        self.step[:, later] = np.where(impossible, -np.inf, self.step[:, later])
        self.show = [norm(c.astype(float)) for c in show]

    def emit(self, x: np.ndarray) -> np.ndarray:
        return sum(table[:, x[:, f]].T for f, table in enumerate(self.show))

    def through(self, x: np.ndarray) -> np.ndarray:
        """Best score from each state before the lines to each at the last line."""
        emit = self.emit(x)
        best = self.step + emit[0]
        for e in emit[1:]:
            best = (best[:, :, None] + self.step[None, :STATES, :]).max(axis=1) + e
        return best

    def path(self, x: np.ndarray, before: int, last: int) -> np.ndarray:
        """Most likely states between the state before and that of the last line."""
        emit = self.emit(x)
        best = self.step[before] + emit[0]
        back = np.zeros((len(x), STATES), np.int64)
        for k in range(1, len(x)):
            score = best[:, None] + self.step[:STATES]
            back[k] = score.argmax(axis=0)
            best = score.max(axis=0) + emit[k]
        out = np.empty(len(x), np.int64)
        out[-1] = last
        for k in range(len(x) - 1, 0, -1):
            out[k - 1] = back[k, out[k]]
        return out


def true_states(turns: list) -> np.ndarray:
    """States of the lines of turns with known roles."""
    out = []
    for t in turns:
        r = ROLES.index(t["role"]) if t["role"] in ROLES else 1
        out.extend([2 * r] + [2 * r + 1] * (len(t["lines"]) - 1))
    return np.array(out, np.int64)


def transcripts(conversations: DataFrame) -> DataFrame:
    """Raw transcripts of (conv_id, turn, role, text): (conv, conv_id, segment,
    turns array<struct<turn, role, lines>>).

    The style of a conversation's markers follows from a hash of its id; a
    part of the turns after the first have no marker, only a blank line
    before them. The roles are carried beside the lines, for learning and
    comparison; the parser reads the lines alone."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").distinct()
    alone = F.col("conv_id").isNull() | F.col("turn").isNull()
    conv = F.when(alone, F.concat(F.lit("row "), F.xxhash64(F.coalesce("conv_id", F.lit(-1)), "turn", "role", "text").cast("string"))).otherwise(F.col("conv_id").cast("string"))
    style, drop = F.pmod(F.xxhash64("conv_id"), F.lit(5)), F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))

    def names(system: str, user: str, assistant: str) -> Column:
        return F.when(F.col("role") == "system", system).when(F.col("role") == "assistant", assistant).otherwise(user)

    mark = (
        F.when(style == 0, names("System: ", "User: ", "Assistant: "))
        .when(style == 1, names("Context: ", "Human: ", "AI: "))
        .when(style == 2, names("### Instructions\n", "### Instruction\n", "### Response\n"))
        .when(style == 3, names("[system] ", "[user] ", "[assistant] "))
        .otherwise(names("<|system|>\n", "<|user|>\n", "<|assistant|>\n"))
    )
    raw = F.concat(F.when((drop == 0) & (F.col("turn") > 0), F.lit("")).otherwise(mark), F.coalesce("text", F.lit("")))
    return (
        rows.select(conv.alias("conv"), "conv_id", F.floor(F.coalesce("turn", F.lit(0)) / SEGMENT).alias("segment"), "turn", "role", F.split(F.concat(raw, F.lit("\n")), "\n").alias("lines"))
        .groupBy("conv", "conv_id", "segment")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "lines"))).alias("turns"))  # SEGMENT turns
    )


def fit(segments: DataFrame) -> Model:
    """The model, counted over all segments with known roles."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        step = np.zeros((STATES + 1, STATES), np.int64)
        show = [np.zeros((STATES, n), np.int64) for n in FEATURES]
        for segment, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            s = true_states(turns)
            x = features(turns, segment)
            if segment == 0:
                step[START, s[0]] += 1
            np.add.at(step, (s[:-1], s[1:]), 1)
            for f, table in enumerate(show):
                np.add.at(table, (s, x[:, f]), 1)
        flat = np.concatenate([step.ravel(), *(t.ravel() for t in show)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["cell", "n"])

    cells = arrow_map(segments.select("segment", "turns"), run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros((STATES + 1) * STATES + STATES * sum(FEATURES), np.int64)
    for r in cells.collect():  # a table of fixed size
        flat[r["cell"]] = r["n"]
    step, at, show = flat[: (STATES + 1) * STATES].reshape(STATES + 1, STATES), (STATES + 1) * STATES, []
    for n in FEATURES:
        show.append(flat[at: at + STATES * n].reshape(STATES, n))
        at += STATES * n
    return Model(step, show)


def render(lines: list[str], states: np.ndarray, opened: bool) -> tuple[str, int]:
    """(canonical text, turns begun); ``opened`` tells that a turn before is
    still open. The last turn is left open."""
    out: list[str] = []
    turns = 0
    for line, s in zip(lines, states.tolist(), strict=True):
        if s % 2 == 0:
            if opened:
                out.append("<|end|>")
            out.append(f"<|{ROLES[s // 2]}|>")
            line = line[marker(line)[1]:]
            turns, opened = turns + 1, True
        if line.strip():
            out.append(line)
    return "\n".join(out), turns


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_lines, n_turns, n_agree, rendered) for each conversation:
    lines, recovered turns, lines whose recovered role is the recorded one,
    and the canonical text."""
    segments = written(transcripts(conversations), "transcripts")
    model = segments.sparkSession.sparkContext.broadcast(fit(segments))

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for segment, turns in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            out.append(model.value.through(features(turns, segment)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["conv", "segment", "scores"])

    def chain(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        conv, number, before, last = [], [], [], []
        for c, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tables = [np.frombuffer(r["scores"]).reshape(STATES + 1, STATES) for r in rows]
            best, back = tables[0][START], []
            for t in tables[1:]:
                reach = best[:, None] + t[:STATES]
                back.append(reach.argmax(axis=0))
                best = reach.max(axis=0)
            ends = [int(best.argmax())]
            for b in reversed(back):
                ends.append(int(b[ends[-1]]))
            ends.reverse()
            for k, r in enumerate(rows):
                conv.append(c)
                number.append(r["segment"])
                before.append(ends[k - 1] if k else START)
                last.append(ends[k])
        yield pa.RecordBatch.from_arrays([pa.array(conv, pa.string()), pa.array(number, pa.int64()), pa.array(before, pa.int64()), pa.array(last, pa.int64())],
                                         names=["conv", "segment", "before", "last"])

    def fill(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        col = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()
        found = []
        for segment, turns, before, last in zip(col("segment"), col("turns"), col("before"), col("last"), strict=True):
            lines = [line for t in turns for line in t["lines"]]
            states = model.value.path(features(turns, segment), before, last)
            text, n_turns = render(lines, states, before != START)
            found.append((len(lines), n_turns, int((states // 2 == true_states(turns) // 2).sum()), text))
        n_lines, n_turns, agree, text = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(batch.schema.get_field_index(c)) for c in ("conv", "conv_id", "segment")), pa.array(n_lines, pa.int64()), pa.array(n_turns, pa.int64()), pa.array(agree, pa.int64()), pa.array(text, pa.string())],
            names=["conv", "conv_id", "segment", "n_lines", "n_turns", "n_agree", "text"],
        )

    scores = arrow_map(segments.select("conv", "segment", "turns"), score, "conv string, segment long, scores binary")
    chains = scores.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("segment", "scores"))).alias("rows"))  # one row a segment
    ends = written(arrow_map(chains, chain, "conv string, segment long, before long, last long"), "chains")
    parts = arrow_map(segments.join(ends, ["conv", "segment"]), fill, "conv string, conv_id long, segment long, n_lines long, n_turns long, n_agree long, text string")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("segment", "text"))), lambda s: s["text"])
    return (
        parts.groupBy("conv")
        .agg(F.max("conv_id").alias("conv_id"), F.sum("n_lines").alias("n_lines"), F.sum("n_turns").alias("n_turns"), F.sum("n_agree").alias("n_agree"), ordered.alias("texts"))
        .select("conv_id", "n_lines", "n_turns", "n_agree", F.concat(F.array_join("texts", "\n"), F.lit("\n<|end|>")).alias("rendered"))
    )
