"""Chat formatting by a finite-state machine over roles.

A ``Template`` declares the machine: for a state and a role, what is written before and after
the turn's text, the next state, and whether the text is under the loss. A turn for which nothing is declared
is out of order: it is counted as a fault and written in the template's ``odd`` form, which names the role, so that
nothing is lost. Control strings inside texts and roles are escaped by a backslash after their first
character (backslashes are doubled), so the output can be read back: ``read`` runs the same machine over it.

Rows are ordered by conversation and turn in ranges, and each range is formatted as a stream: a conversation may
be spread over many tasks, and none is ever gathered. A range does not know the state in which its first conversation
comes in. It is formatted for each state until all of them have come to the same one (a turn later, with the present template);
the ranges' last states, one row each, say on the driver which of these variants holds.
The output is a table of pieces: segments of text, each with its loss flag, of at most about ``piece_chars``
characters. A conversation that lies in one piece is read back where it is, without a shuffle.

Defined cases: a null text or role is empty; rows without a turn come first; rows of one turn come by role, then hash, then
text, and repeated rows are turns of their own; rows with a null conversation are one conversation; any role
may come, known or not, and a conversation may begin and end anywhere. Only the named columns are read.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import saved, table


@dataclass(frozen=True)
class Turn:
    """How the text of a turn is written, and the state that it leads to."""

    before: str
    after: str
    state: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``turns``: by state and role. ``odd``: the form of any other turn, {role} in ``before``; ``after_odd``: the state it leads to, by role, else ``closed``."""

    controls: tuple[str, ...]
    turns: dict[tuple[str, str], Turn]
    odd: Turn
    after_odd: dict[str, str]
    loss_roles: tuple[str, ...]
    start: str = "start"

    @property
    def states(self) -> list[str]:
        return sorted({self.start, self.odd.state, *self.after_odd.values(), *(s for s, _ in self.turns), *(t.state for t in self.turns.values())})

    @cached_property
    def control(self) -> re.Pattern:
        return re.compile("|".join(re.escape(c) for c in sorted(self.controls, key=len, reverse=True)))

    def escaped(self, text: str) -> str:
        if "\\" in text:
            text = text.replace("\\", "\\\\")
        return self.control.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)

    @staticmethod
    def plain(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text

    def write(self, state: str, role: str) -> tuple[Turn, bool]:
        """The form of a turn, and whether it is in order."""
        turn = self.turns.get((state, role))
        if turn:
            return turn, True
        before = self.odd.before.replace("{role}", self.escaped(role))
        return Turn(before, self.odd.after, self.after_odd.get(role, self.odd.state), role in self.loss_roles), False

    def read(self, state: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(role, text, state after it) of each turn of a formatted text that begins in ``state``."""
        control, at = self.control, 0
        lead, named = self.odd.before.split("{role}")
        while at < len(text):
            role = None
            if text.startswith(lead, at):
                end = text.index(named, at + len(lead))
                role = self.plain(text[at + len(lead) : end])
                turn, begin = Turn("", self.odd.after, self.after_odd.get(role, self.odd.state)), end + len(named)
            else:
                known = [(t.before, r, t) for (s, r), t in self.turns.items() if s == state and text.startswith(t.before, at)]
                before, role, turn = max(known, key=lambda k: len(k[0]))
                begin = at + len(before)
            end = control.search(text, begin).start() - control.search(turn.after).start()
            at, state = end + len(turn.after), turn.state
            yield role, self.plain(text[begin:end]), state


#: Instruction turns between [INST] and [/INST], answers up to </s>, the system text inside the first instruction.
INSTRUCT = Template(
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"),
    turns={
        ("start", "system"): Turn("<s>[INST] <<SYS>>\n", "\n<</SYS>>\n\n", "told"),
        ("start", "user"): Turn("<s>[INST] ", " [/INST]", "asked"),
        ("told", "user"): Turn("", " [/INST]", "asked"),
        ("asked", "assistant"): Turn(" ", " </s>", "closed", loss=True),
        ("closed", "user"): Turn("<s>[INST] ", " [/INST]", "asked"),
    },
    odd=Turn("<s>[ROLE] {role} [/ROLE] ", " </s>", "closed"),
    after_odd={"user": "asked"},
    loss_roles=("assistant",),
)

SEGMENTS = "array<struct<text:string,loss:boolean>>"
_PIECE = f"conv long, chunk int, piece int, variant string, head boolean, tail boolean, begins boolean, ends boolean, n_turns long, faults long, segments {SEGMENTS}, last array<struct<a:string,b:string>>"
_FIELDS = [f.split(" ")[0] for f in re.split(r", (?=\w+ )", _PIECE)]


class _Open:
    """A conversation as it is written: for each state it may have come in with (``None``: known), the state and the piece so far."""

    def __init__(self, conv: int | None, states: dict[str | None, str], head: bool):
        self.conv, self.head, self.live, self.came = conv, head, states, dict(states)
        self.begins, self.piece = True, 0
        self.clear()

    def clear(self) -> None:
        self.segments = {v: [] for v in self.live}
        self.faults = dict.fromkeys(self.live, 0)
        self.turns = self.chars = 0

    def add(self, template: Template, role: str, text: str) -> None:
        text = template.escaped(text)
        for v, state in self.live.items():
            turn, known = template.write(state, role)
            self.faults[v] += not known
            self.live[v] = turn.state
            for part, loss in ((turn.before, False), (text, turn.loss), (turn.after, False)):
                have = self.segments[v]
                if have and not loss and not have[-1][1]:
                    have[-1] = (have[-1][0] + part, False)
                else:
                    have.append((part, loss))
        self.turns += 1
        self.chars += len(text)

    def rows(self, chunk: int, ends: bool, tail: bool) -> Iterator[dict]:
        last = [{"a": a or "", "b": self.live.get(a, self.live.get(None))} for a in self.came] if tail else None
        for v, segments in self.segments.items():
            flat = [{"text": t, "loss": x} for t, x in segments]
            yield dict(zip(_FIELDS, (self.conv, chunk, self.piece, v, self.head, tail, self.begins, ends, self.turns, self.faults[v], flat, last), strict=True))
        self.begins, self.piece = False, self.piece + 1

    def settle(self) -> None:
        """Once all states are the same one, the state is known."""
        if len(self.live) > 1 and len(set(self.live.values())) == 1:
            self.live = {None: next(iter(self.live.values()))}


def format_chats(rows: DataFrame, template: Template = INSTRUCT, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece_chars: int = 1 << 20) -> DataFrame:
    """Pieces (conv, chunk, piece, begins, ends, n_turns, faults, segments) of every conversation, in that order.

    ``begins`` and ``ends`` say whether a piece holds the conversation's beginning and end.
    """
    spark = rows.sparkSession
    narrow = rows.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    order = [F.col("conv"), F.col("turn"), F.col("role"), F.xxhash64("text")]
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("conv", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, now, out, size = TaskContext.get().partitionId(), None, [], 0
        schema = pa.schema(
            [("conv", pa.int64()), ("chunk", pa.int32()), ("piece", pa.int32()), ("variant", pa.string()), *((c, pa.bool_()) for c in ("head", "tail", "begins", "ends")), ("n_turns", pa.int64()), ("faults", pa.int64())]
            + [("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))), ("last", pa.list_(pa.struct([("a", pa.string()), ("b", pa.string())])))]
        )
        for batch in batches:
            for c, r, t in zip(*(batch.column(k).to_pylist() for k in ("conv", "role", "text")), strict=True):
                if now is None or c != now.conv:
                    if now is not None:
                        out.extend(now.rows(chunk, ends=True, tail=False))
                    now = _Open(c, {None: template.start}, False) if now is not None else _Open(c, {s: s for s in template.states}, True)
                now.add(template, r, t)
                size += len(t)
                settles = len(now.live) > 1 and len(set(now.live.values())) == 1
                if settles or now.chars >= piece_chars:
                    out.extend(now.rows(chunk, ends=False, tail=False))
                    now.settle()
                    now.clear()
                if size >= piece_chars:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
        if now is not None:
            out.extend(now.rows(chunk, ends=True, tail=True))
            yield pa.RecordBatch.from_pylist(out, schema)

    made = saved(ordered.mapInArrow(run, _PIECE), "chat-pieces")
    # a row for each range: its first and last conversation, and the states in which that one may come in and end
    firsts = {r["chunk"]: r["conv"] for r in made.where("head").select("chunk", "conv").distinct().collect()}
    lasts = {r["chunk"]: r for r in made.where("tail").select("chunk", "conv", "head", "last").distinct().collect()}
    came, before = [], None
    for chunk in sorted(firsts):
        goes_on = before is not None and before[0] == firsts[chunk]
        if goes_on:
            came[-1] = (*came[-1][:3], True)
        state = before[1] if goes_on else template.start
        came.append((chunk, state, goes_on, False))
        last = lasts[chunk]
        before = (last["conv"], {x["a"]: x["b"] for x in last["last"]}[state if last["head"] else ""])
    which = F.broadcast(spark.createDataFrame(came, "chunk int, state string, goes_on boolean, open boolean"))  # a row for each range
    held = made.join(which, "chunk").where("variant is null or variant = state")
    begins = F.col("begins") & ~(F.col("head") & F.col("goes_on"))
    ends = F.col("ends") & ~(F.col("tail") & F.col("open"))
    return held.select(F.col("conv").alias(conv), "chunk", "piece", begins.alias("begins"), ends.alias("ends"), "n_turns", "faults", "segments")


def read_back(pieces: DataFrame, template: Template = INSTRUCT, conv: str = "conv_id") -> DataFrame:
    """Each conversation as it is read from the output: number of turns, digests of turns and of the text under the loss, faults and characters."""
    schema = f"{conv} long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, faults long"
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list = []
        for batch in batches:
            out = {n: [] for n in names}
            for c, begins, ends, faults, segments in zip(*(batch.column(k).to_pylist() for k in ("conv", "begins", "ends", "faults", "segments")), strict=True):
                if begins:
                    now = [template.start, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text, state in template.read(now[0], "".join(s["text"] for s in segments)):
                    now[0], now[1] = state, now[1] + 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for s in segments:
                    now[5] += len(s["text"])
                    if s["loss"]:
                        text = template.plain(s["text"])
                        now[3] += len(text)
                        now[4].update(text.encode())
                now[6] += faults
                if ends:
                    for n, v in zip(names, (c, now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5], now[6]), strict=True):
                        out[n].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], pa.string() if n.endswith("sha256") else pa.int64()) for n in names], names=names)

    pieces = pieces.select(F.col(conv).alias("conv"), "chunk", "piece", "begins", "ends", "faults", "segments")
    parts = pieces.where("not (begins and ends)").repartition("conv").sortWithinPartitions("conv", "chunk", "piece")
    return pieces.where("begins and ends").mapInArrow(run, schema).unionAll(parts.mapInArrow(run, schema))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back from the output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    return read_back(format_chats(rows.unionByName(more)))
