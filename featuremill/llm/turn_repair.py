"""Conversation structure repair (operator 11): generalised LR with weighted edits.

The roles of a conversation have to spell a sentence of a grammar. A parser built from the
grammar's productions (LR(0) item sets) reads them turn by turn and may keep a turn, rerole it,
delete it, or insert a turn before it, each at a price. All parses run at once: the front is a
graph-structured stack, whose nodes share their lower parts, and of the nodes with the same
top only the one of smallest (cost, audit) is kept; the audit is the edits' initials, in order.
This loses nothing: equal tops have equal futures in a grammar whose stacks are bounded (checked
when the parser is built), and after the same turns, two audits of equal cost are never one the
beginning of the other, so the smaller stays smaller whatever follows.

Long conversations are cut. Turns are sorted into ranges by (conversation, turn, role, text
hash), and each range parses its part of a conversation; where a conversation may go on
from the range before, it is parsed from every stack the grammar knows. Joining the parts is
the same minimum over (cost, audit). This works on narrow rows without texts: repeated rows are
counted together first, and the turn that says a text first comes from a grouped minimum, so
neither a repeated turn nor a text that fills a conversation meets in one task. Texts move
once, to the repaired conversations, which stream through a task a turn at a time.

Defined results: a null conversation id is a conversation of its own; a null turn comes first;
a null role or text is one space; an empty role fits nowhere, like one that the grammar does
not know; equal turns are ordered by role and then by the SHA-256 of
the text; repeated rows are duplicates; a conversation without rows has no edits, zeros and an
empty audit; an empty table gives an empty result; further columns are ignored. Memory per
task: one Arrow batch and the audits of the conversation at hand (an audit is a value of the
result, a character a turn).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import stored

#: Characters of the audit that are kept as one text before they are chained.
CHUNK = 512


@dataclass(frozen=True)
class Grammar:
    """``productions`` of left side and right side; terminals are role initials. ``roles``: what
    rerole and insert may write, by initial."""
    start: str = "S"
    productions: tuple = (("S", ()), ("S", ("P",)), ("S", ("s", "P")),
                          ("P", ("u", "a")), ("P", ("P", "u", "a")))
    roles: tuple = (("a", "assistant"), ("u", "user"))
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class Parser:
    """LR(0) automaton of a grammar, and the stacks that its sentences can build."""

    def __init__(self, grammar: Grammar = Grammar()):
        self.grammar = grammar
        rules = grammar.productions
        left = {lhs for lhs, _ in rules}

        def closure(items):
            items = set(items)
            while True:
                more = {(i, 0) for r, at in items for i, (lhs, _) in enumerate(rules)
                        if at < len(rules[r][1]) and rules[r][1][at] == lhs} - items
                if not more:
                    return frozenset(items)
                items |= more

        def goto(state, symbol):
            return closure({(r, at + 1) for r, at in state
                            if at < len(rules[r][1]) and rules[r][1][at] == symbol})

        first = closure({(i, 0) for i, (lhs, _) in enumerate(rules) if lhs == grammar.start})
        self.states, self.moves, todo = [first], {}, [0]
        symbols = sorted({x for _, rhs in rules for x in rhs})
        while todo:
            at = todo.pop()
            for symbol in symbols:
                state = goto(self.states[at], symbol)
                if state:
                    if state not in self.states:
                        self.states.append(state)
                        todo.append(len(self.states) - 1)
                    self.moves[at, symbol] = self.states.index(state)
        # the rule that a state has to reduce by before anything is shifted: it has no other item
        self.reduces = {i: next(iter(s))[0] for i, s in enumerate(self.states)
                        if len(s) == 1 and next(iter(s))[1] == len(rules[next(iter(s))[0]][1])
                        and rules[next(iter(s))[0]][0] != grammar.start}
        # whether the input may end in a state: a whole sentence is on the stack
        self.accepts = {i for i, s in enumerate(self.states)
                        if any(rules[r][0] == grammar.start and at == len(rules[r][1]) for r, at in s)}
        self.terminals = [x for x in symbols if x not in left]
        self.stacks: list[tuple] = [(0,)]
        for stack in self.stacks:
            for x in self.terminals:
                new = self._shift(stack, x)
                if new is not None and new not in self.stacks:
                    self.stacks.append(new)
            if len(self.stacks) > 1000:
                raise ValueError("the grammar's stacks are not bounded")
        number = {s: i for i, s in enumerate(self.stacks)}
        #: (stack, initial) -> stack, by number
        self.shift = {(i, x): number[new] for i, s in enumerate(self.stacks) for x in self.terminals
                      if (new := self._shift(s, x)) is not None}
        self.top = [s[-1] for s in self.stacks]
        self.final = [s[-1] in self.accepts for s in self.stacks]
        self._check_tops()

    def _shift(self, stack: tuple, symbol: str) -> tuple | None:
        to = self.moves.get((stack[-1], symbol))
        if to is None:
            return None
        stack = (*stack, to)
        while stack[-1] in self.reduces:
            lhs, rhs = self.grammar.productions[self.reduces[stack[-1]]]
            stack = stack[:len(stack) - len(rhs)]
            stack = (*stack, self.moves[stack[-1], lhs])
        return stack

    def _check_tops(self) -> None:
        """Stacks of one top take the same continuations to an accepted end."""
        kind: list = [int(f) for f in self.final]
        while True:  # tell stacks apart by what follows, until nothing new shows
            told = [(k, *(kind[self.shift[i, x]] if (i, x) in self.shift else None for x in self.terminals))
                    for i, k in enumerate(kind)]
            new = [told.index(t) for t in told]
            if len(set(new)) == len(set(kind)):
                break
            kind = new
        if any(kind[i] != kind[self.top.index(top)] for i, top in enumerate(self.top)):
            raise ValueError("stacks of one top have different futures")


@dataclass
class Front:
    """The graph-structured stack's front: top -> (cost, rank, tail, chain, stack). The audit is
    the chained texts and the tail; ``rank`` orders the chains."""
    parser: Parser
    nodes: dict = field(default_factory=dict)

    @classmethod
    def at(cls, parser: Parser, stack: int) -> "Front":
        return cls(parser, {parser.top[stack]: (0, 0, "", None, stack)})

    def inserted(self) -> dict:
        """The front with all insertions that may come before the next turn."""
        p, best = self.parser, dict(self.nodes)
        todo = list(best.values())
        while todo:
            cost, rank, tail, chain, stack = todo.pop()
            for initial, _ in p.grammar.roles:
                to = p.shift.get((stack, initial))
                if to is not None:
                    new = (cost + p.grammar.insert, rank, tail + "I", chain, to)
                    if _better(new, best.get(p.top[to])):
                        best[p.top[to]] = new
                        todo.append(new)
        return best

    def read(self, initial: str, must_delete: bool, truncated: bool) -> None:
        """One turn more."""
        p, g, after = self.parser, self.parser.grammar, {}

        def put(node):
            top = p.top[node[4]]
            if _better(node, after.get(top)):
                after[top] = node

        more = g.truncated if truncated else 0
        for cost, rank, tail, chain, stack in self.inserted().values():
            put((cost + g.delete, rank, tail + "D", chain, stack))
            if must_delete:
                continue
            to = p.shift.get((stack, initial))
            if to is not None:
                put((cost + more, rank, tail + "K", chain, to))
            for other, _ in g.roles:
                to = p.shift.get((stack, other))
                if to is not None and other != initial:
                    put((cost + more + g.rerole, rank, tail + "R", chain, to))
        self.nodes = after
        if any(len(n[2]) >= CHUNK for n in after.values()):
            rank = {x: i for i, x in enumerate(sorted({n[1:3] for n in after.values()}))}
            self.nodes = {t: (n[0], rank[n[1:3]], "", (n[3], n[2]), n[4]) for t, n in after.items()}

    def exits(self) -> list[tuple[int, int, str]]:
        """(stack, cost, audit) of each top."""
        return [(n[4], n[0], _audit(n)) for n in self.nodes.values()]

    def end(self) -> tuple[int, str]:
        """(cost, audit) of the cheapest whole parse."""
        return min((n[0], _audit(n)) for n in self.inserted().values() if self.parser.final[n[4]])


def _better(new: tuple, old: tuple | None) -> bool:
    return old is None or new[:3] < old[:3]


def _audit(node: tuple) -> str:
    out, chain = [node[2]], node[3]
    while chain is not None:
        chain, text = chain
        out.append(text)
    return "".join(reversed(out))


def join_parts(parser: Parser, parts: Iterable[list]) -> tuple[int, str]:
    """(cost, audit) of a conversation from its parts' exits, each (from, to, cost, audit) with
    stacks by number; the first part starts from the empty stack."""
    front = {parser.top[0]: (0, "", 0)}
    for exits in parts:
        after: dict = {}
        for cost, audit, stack in front.values():
            for x in exits:
                if x["from"] == stack:
                    new = (cost + x["cost"], audit + x["audit"], x["to"])
                    top = parser.top[x["to"]]
                    if top not in after or new[:2] < after[top][:2]:
                        after[top] = new
        front = after
    whole = Front(parser, {t: (c, a, "", None, s) for t, (c, a, s) in front.items()})
    # the audits are compared as the ranks that the front expects
    rank = {a: i for i, a in enumerate(sorted({n[1] for n in whole.nodes.values()}))}
    whole.nodes = {t: (n[0], rank[n[1]], "", (None, n[1]), n[4]) for t, n in whole.nodes.items()}
    return whole.end()


# -- turns -----------------------------------------------------------------------------------

SEEN = r"[^\x20\x09-\x0D]"


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def with_key(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, key): null roles and texts are one space; the key orders equal
    turns and tells texts apart."""
    return (turns.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"))
            .withColumn("key", F.unhex(F.sha2("text", 256))))


ORDER = ["conv_id", "turn", "role", "key"]
EXITS = "array<struct<from:int,to:int,cost:long,audit:string>>"
FIGURES = ["blank", "duplicate", "truncated", "illegal", "n_turns"]


def faulty_turns(turns: DataFrame) -> DataFrame:
    """Different turns without their texts: conv_id, turn, role, key, n (equal rows), blank, cut (no
    stop at the end) and again (said by an earlier turn)."""
    blank = ~F.col("text").rlike(SEEN)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    rows = (with_key(turns).groupBy(*ORDER, blank.alias("blank"), cut.alias("cut"))
            .agg(F.count(F.lit(1)).alias("n")))
    # a null turn is the earliest
    first = rows.groupBy("conv_id", "role", "key").agg(F.min(F.struct(
        F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("first.turn").alias("t"), F.col("role").alias("r"),
                         F.col("key").alias("k"))
    same = (F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
            & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k")))
    return rows.join(first, same, "left").withColumn("again", F.col("k").isNull()).drop("c", "t", "r", "k")


def repair_plan(turns: DataFrame, grammar: Grammar = Grammar(), partitions: int | None = None) -> DataFrame:
    """Per conversation of ``turns`` (conv_id, turn, role, text): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit."""
    parser = Parser(grammar)
    spark = turns.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = turns.schema["conv_id"].dataType.simpleString()
    ordered = (faulty_turns(turns).repartitionByRange(n, *ORDER).sortWithinPartitions(*ORDER)
               .select("conv_id", "turn", "role", "n", "blank", "cut", "again"))
    schema = (f"conv_id {id_type}, part int, {', '.join(f'{f} long' for f in FIGURES)}, first string, last string, "
              f"low long, high long, exits {EXITS}")
    exit_type = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()),
                                    ("audit", pa.string())]))
    names = ["conv_id", "part", *FIGURES, "first", "last", "low", "high", "exits"]

    def parse(batches):
        part, current, kind = TaskContext.get().partitionId(), None, None

        def closed():
            exits = [{"from": e, "to": s, "cost": c, "audit": a} for e, f in fronts.items() for s, c, a in f.exits()]
            return [current[0], part, *figures, *edge, *span, exits]

        def of(rows):
            cols = list(zip(*rows))
            types = [kind, pa.int32(), *[pa.int64()] * len(FIGURES), pa.string(), pa.string(), pa.int64(), pa.int64(),
                     exit_type]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            for conv, turn, role, n, blank, cut, again in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or conv != current[0]:
                    # only the first conversation may go on from the range before
                    entries = [0] if current is not None else range(len(parser.stacks))
                    if current is not None:
                        done.append(closed())
                    current, figures = (conv,), [0] * len(FIGURES)
                    fronts = {e: Front.at(parser, e) for e in entries}
                    edge, span = [None, None], [None, None]
                initial = role[:1]
                gone = blank or again
                fault = 0 if blank else 1 if again else 2 if cut else None
                if fault is not None:
                    figures[fault] += 1
                figures[0 if blank else 1] += n - 1
                pair = (edge[1], initial)
                figures[3] += (edge[1] is not None and not legal(*pair)) + (n - 1) * (not legal(initial, initial))
                if turn is not None and turn != span[1]:
                    figures[4] += 1
                    span = [turn if span[0] is None else span[0], turn]
                edge = [initial if edge[0] is None else edge[0], initial]
                for front in fronts.values():
                    front.read(initial, gone, cut)
                    for _ in range(n - 1):
                        front.read(initial, True, cut)
            if done:
                yield of(done)
        if current is not None:
            yield of([closed()])

    def legal(a: str, b: str) -> bool:
        return a + b in LEGAL

    def join(batches):
        held, kind = [], None

        def whole():
            figures = [sum(r[f] for r in held) for f in FIGURES]
            for a, b in zip(held, held[1:]):
                figures[3] += not legal(a["last"], b["first"])
            spans = [(r["low"], r["high"]) for r in held if r["low"] is not None]
            turns = figures[4] - sum(a[1] == b[0] for a, b in zip(spans, spans[1:]))
            gaps = spans[-1][1] - spans[0][0] + 1 - turns if spans else 0
            return [held[0]["conv_id"], gaps, *figures[:4], *join_parts(parser, (r["exits"] for r in held))]

        def of(rows):
            cols = list(zip(*rows))
            types = [kind, *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    done.append(whole())
                    held.clear()
                held.append(row)
            if done:
                yield of(done)
        if held:
            yield of([whole()])

    return (ordered.mapInArrow(parse, schema).repartition("conv_id").sortWithinPartitions("conv_id", "part")
            .mapInArrow(join, f"conv_id {id_type}, gaps long, blank long, duplicate long, truncated long, "
                              "illegal long, cost long, audit string"))


#: Neighbouring role initials that may follow each other.
LEGAL = ("su", "ua", "au")


def repaired_turns(turns: DataFrame, plan: DataFrame, grammar: Grammar = Grammar()) -> DataFrame:
    """The repaired conversations: conv_id, position, role, text, action (of the audit), in order; a
    conversation's turns come one after the other in one task, after its audit."""
    parser = Parser(grammar)
    id_type = turns.schema["conv_id"].dataType.simpleString()
    role_of = dict(grammar.roles)
    none = F.lit(None).cast("string")
    rows = with_key(turns).withColumn("audit", none)
    told = plan.select("conv_id", F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), none.alias("role"),
                       none.alias("text"), F.lit(None).cast("binary").alias("key"), "audit")
    ordered = (rows.union(told).withColumn("is_turn", F.col("audit").isNull()).repartition("conv_id")
               .sortWithinPartitions("conv_id", "is_turn", "turn", "role", "key")
               .select("conv_id", "role", "text", "audit"))

    def walk(batches):
        actions = at = stack = position = None
        for batch in batches:
            out = []

            def put(conv, role, text, action):
                nonlocal stack, position
                stack = parser.shift[stack, role[:1]]
                out.append((conv, position, role, text, action))
                position += 1

            def inserts(conv):
                nonlocal at
                while at < len(actions) and actions[at] == "I":
                    put(conv, follow("I", None), "", "I")
                    at += 1

            def follow(action, initial):
                """The role that an insertion or a rerole writes: the parse goes on with one only."""
                able = [x for x in role_of if x != initial and (stack, x) in parser.shift]
                if len(able) != 1:
                    raise ValueError("the grammar leaves the written role open")
                return role_of[able[0]]

            for conv, role, text, audit in zip(*(c.to_pylist() for c in batch.columns)):
                if audit is not None:
                    actions, at, stack, position = audit, 0, 0, 0
                    inserts(conv)
                    continue
                action = actions[at]
                at += 1
                if action == "K":
                    put(conv, role, text, "K")
                elif action == "R":
                    put(conv, follow("R", role[:1]), text, "R")
                inserts(conv)
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], batch.schema.field("conv_id").type), pa.array(cols[1], pa.int64()),
                     *(pa.array(c, pa.string()) for c in cols[2:])],
                    names=["conv_id", "position", "role", "text", "action"])

    return ordered.mapInArrow(walk, f"conv_id {id_type}, position long, role string, text string, action string")


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """Per conversation of ``repaired_turns``' result, as it stands: conv_id and repaired_sha256, of
    its ``role:text`` joined by line feeds."""
    id_type = repaired.schema["conv_id"].dataType.simpleString()

    def digest(batches):
        current, told, kind = None, None, None

        def of(rows):
            ids, found = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(found)], names=["conv_id", "repaired_sha256"])

        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            for conv, position, role, text in zip(*(batch.column(c).to_pylist()
                                                    for c in ("conv_id", "position", "role", "text"))):
                if not position:
                    if current is not None:
                        done.append((current[0], told.hexdigest()))
                    current, told = (conv,), hashlib.sha256()
                told.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            if done:
                yield of(done)
        if current is not None:
            yield of([(current[0], told.hexdigest())])

    return repaired.mapInArrow(digest, f"conv_id {id_type}, repaired_sha256 string")


def repair(turns: DataFrame, conversations: DataFrame | None = None, grammar: Grammar = Grammar()) -> DataFrame:
    """``repair_plan`` and ``repaired_digests`` of ``turns``, one row for every conv_id of
    ``conversations`` (default: of ``turns``)."""
    plan = stored(repair_plan(turns, grammar), "repair-plan")
    digests = repaired_digests(repaired_turns(turns, plan, grammar))
    ids = (turns if conversations is None else conversations).select("conv_id").distinct()
    plan, digests = plan.withColumnRenamed("conv_id", "p"), digests.withColumnRenamed("conv_id", "d")
    return (ids.join(plan, F.col("conv_id").eqNullSafe(F.col("p")), "left")
            .join(digests, F.col("conv_id").eqNullSafe(F.col("d")), "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in
                                 ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
