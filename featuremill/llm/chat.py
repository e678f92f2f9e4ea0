"""Chat formatting (operator 5): a finite-state machine over roles and a declarative template.

The template names, for each role, the control strings around a turn and whether its text
counts for the loss. Control strings inside texts are escaped reversibly: a backslash goes
after the first character of a control string, one more if there are some already. So the
formatted text can be read back to the very turns (``read_back``).

Turns are range-partitioned by (conversation, turn, role, beginning of the text) and streamed in
order, so a conversation that holds a large share of all turns is spread over tasks (but for
turns of equal number and role whose texts share their first 256 characters: one task sorts those). A task cannot know how its first
conversation began elsewhere; it therefore runs the machine from every state, and the parts
(one or two small rows a partition) are composed in order afterwards.

Defined results: a null text counts as empty, a null role as the role ''; a role unknown to
the template is written with its name; turns with equal numbers are ordered by role and text;
null turn numbers come first; null ids form one conversation; repeated rows are turns of
their own; a conversation that the machine rejects is formatted all the same and marked not
valid from the first wrong turn on; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import stored


#: Characters of a text that say which range a turn falls into, among turns of equal number and
#: role: the driver's sample of range keys does not grow with the length of texts.
RANGE_CHARS = 256


@dataclass(frozen=True)
class Template:
    """roles: role -> (before, after, loss). other: before the name, after the name, after the
    text, for roles not listed. turns: state -> role -> next state, from the state "start";
    a conversation is complete in one of ``final``."""
    roles: dict = field(default_factory=lambda: {
        "system": ("[SYS]", "[/SYS]", False),
        "user": ("[INST]", "[/INST]", False),
        "assistant": ("", "</s>", True)})
    other: tuple = ("[ROLE]", "[/ROLE]", "</s>")
    turns: dict = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"}})
    final: tuple = ("assistant",)

    @property
    def controls(self) -> list[str]:
        own = {c for before, after, _ in self.roles.values() for c in (before, after)} | set(self.other)
        return sorted(own - {""})


class Formatter:
    def __init__(self, template: Template = Template()):
        self.template = template
        controls = template.controls
        heads = {c[0] for c in controls}
        if any(set(c[1:]) & heads or "\\" in c or len(c) < 2 for c in controls):
            # then matches can never overlap, nor reach across the edge of a text
            raise ValueError("only the first character of a control string may start one")
        tails = "|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in controls)
        self._escape = re.compile(f"(?:{tails})")
        self._control = re.compile("|".join(map(re.escape, controls)))
        self.states = ["start", *sorted(set(template.turns) - {"start"}), "wrong"]
        self.number = {s: i for i, s in enumerate(self.states)}

    def escape(self, text: str) -> str:
        return self._escape.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)

    def unescape(self, text: str) -> str:
        return self._escape.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss flag) of one turn; joined, they are its formatted text."""
        if role in self.template.roles:
            before, after, loss = self.template.roles[role]
        else:
            a, b, after = self.template.other
            before, loss = a + self.escape(role) + b, False
        parts = [(before, False), (self.escape(text), loss), (after, False)]
        return [p for p in parts if p[0] or p[1]]

    def read_back(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of the turns of a formatted text."""
        marks = [(m.start(), m.end(), m[0]) for m in self._control.finditer(formatted)]
        open_of = {before: (role, after) for role, (before, after, _) in self.template.roles.items()}
        turns, at, i = [], 0, 0
        while i < len(marks):
            start, end, mark = marks[i]
            if start == at and mark == self.template.other[0]:
                name_end = marks[i + 1]
                role = self.unescape(formatted[end:name_end[0]])
                close = marks[i + 2]
                turns.append((role, self.unescape(formatted[name_end[1]:close[0]])))
                at, i = close[1], i + 3
            elif start == at and mark in open_of:
                close = marks[i + 1]
                turns.append((open_of[mark][0], self.unescape(formatted[end:close[0]])))
                at, i = close[1], i + 2
            else:  # a role without a control string before its text
                turns.append((open_of[""][0], self.unescape(formatted[at:start])))
                at, i = end, i + 1
        return turns

    def step(self, states: list[int], role: str) -> list[int]:
        """The machine's states after a turn, from each of ``states``."""
        turns, number = self.template.turns, self.number
        return [number[turns.get(self.states[s], {}).get(role, "wrong")] for s in states]


SEGMENTS = "array<struct<text:string,loss:boolean>>"


def format_turns(df: DataFrame, template: Template = Template(), partitions: int | None = None) -> DataFrame:
    """Per row of ``df`` (conv_id, turn, role, text): conv_id, position (from 0 in the
    conversation), role, segments (text and loss flag) and valid (whether the machine accepts
    the conversation up to this turn)."""
    own = Formatter(template)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = df.schema["conv_id"].dataType.simpleString()
    turns = (df.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
             # a text's beginning never sorts against the text, so the ranges keep the order of texts
             .withColumn("beginning", F.substring("text", 1, RANGE_CHARS))
             .repartitionByRange(n, "conv_id", "turn", "role", "beginning")
             .sortWithinPartitions("conv_id", "turn", "role", "text")
             .select("conv_id", "role", "text"))
    segment = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))

    def walk(batches):
        part = TaskContext.get().partitionId()
        current, states, position, run = None, None, 0, -1
        for batch in batches:
            rows = []
            ids = batch.column("conv_id")
            for conv, role, text in zip(ids.to_pylist(), batch.column("role").to_pylist(),
                                        batch.column("text").to_pylist()):
                if run < 0 or conv != current:
                    current, position, run = conv, 0, run + 1
                    states = list(range(len(own.states)))
                states = own.step(states, role)
                rows.append((role, [{"text": t, "loss": x} for t, x in own.segments(role, text)], position,
                             states, run))
                position += 1
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cols[0], pa.string()), pa.array(cols[1], segment), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.list_(pa.int32())), pa.array(cols[4], pa.int64()),
                 pa.array([part] * len(rows), pa.int32())],
                names=["conv_id", "role", "segments", "position", "states", "run", "part"])

    walked = stored(turns.mapInArrow(
        walk, f"conv_id {id_type}, role string, segments {SEGMENTS}, position long, states array<int>, "
              "run long, part int"), "turns")
    # the first and the last run of each partition: at most two small rows a partition
    last_run = walked.groupBy("part").agg(F.max("run").alias("last_run"))
    edges = (walked.join(last_run, "part").where("run = 0 or run = last_run")
             .groupBy("part", "run", "conv_id")
             .agg(F.max(F.struct("position", "states")).alias("end"))
             .select("part", "run", "conv_id", "end.position", "end.states").collect())
    begins: dict[int, tuple[int, int]] = {}  # part -> (turns before, state before) of its first run
    before = None  # (conversation, turns, state) at the end of the parts so far
    for e in sorted(edges, key=lambda e: (e.part, e.run)):
        turns_before, state = 0, own.number["start"]
        if e.run == 0 and before is not None and before[0] == e.conv_id:
            turns_before, state = before[1], before[2]
            begins[e.part] = (turns_before, state)
        before = (e.conv_id, turns_before + e.position + 1, e.states[state])
    shared = spark.sparkContext.broadcast(begins)
    wrong, start = own.number["wrong"], own.number["start"]

    def settle(batches):
        known = shared.value
        for batch in batches:
            position, valid = [], []
            for part, run, at, states in zip(*(batch.column(c).to_pylist()
                                               for c in ("part", "run", "position", "states"))):
                turns_before, state = known.get(part, (0, start)) if run == 0 else (0, start)
                position.append(turns_before + at)
                valid.append(states[state] != wrong)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(position, pa.int64()), batch.column("role"),
                 batch.column("segments"), pa.array(valid, pa.bool_())],
                names=["conv_id", "position", "role", "segments", "valid"])

    return walked.mapInArrow(settle, f"conv_id {id_type}, position long, role string, segments {SEGMENTS}, "
                                     "valid boolean")


def read_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation of ``format_turns``' result, read back from the formatted text: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid. A digest takes a
    conversation's turns one after the other, so they stream through one task, a turn at a time."""
    own = Formatter(template)
    id_type = turns.schema["conv_id"].dataType.simpleString()
    final = set(template.final)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    def read(batches):
        state = None

        def row():
            conv, n, told, loss, masked, size, valid, role = state
            return conv, n, told.hexdigest(), loss, masked.hexdigest(), size, valid and role in final

        def batch_of(rows, kind):
            cols = list(zip(*rows))
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        kind = None
        for batch in batches:
            kind, rows = batch.schema.field("conv_id").type, []
            for conv, segments, valid in zip(*(batch.column(c).to_pylist()
                                               for c in ("conv_id", "segments", "valid"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        rows.append(row())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True, ""]
                formatted = "".join(s["text"] for s in segments)
                masked = own.unescape("".join(s["text"] for s in segments if s["loss"]))
                for role, text in own.read_back(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                    state[7] = role
                state[3] += len(masked)
                state[4].update(masked.encode())
                state[5] += len(formatted)
                state[6] = state[6] and valid
            if rows:
                yield batch_of(rows, kind)
        if state is not None:
            yield batch_of([row()], kind)

    ordered = (turns.repartition("conv_id").sortWithinPartitions("conv_id", "position")
               .select("conv_id", "segments", "valid"))
    return ordered.mapInArrow(read, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long, valid boolean")
