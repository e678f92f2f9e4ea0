"""Secret scans (operator 2): a trigram inverted index in front of regular expressions.

Each rule's pattern is turned into a Boolean query over the trigrams that every match must
hold: a disjunction of alternatives, each a conjunction of trigrams (``trigram_query``).
The index maps (block, trigram) to the posting list of the documents of a block that hold
the trigram in their lower-cased text; blocks are hash ranges of about ``BLOCK_ROWS``
documents, so no list grows with the data. A rule's candidates are the union over its
alternatives of the intersected postings; only candidates are joined back to their texts and
verified with the pattern. A rule without mandatory trigrams (a pure run of hexadecimal
digits) scans all texts.

Positions (code points, end exclusive) come from splitting a text at the matches: running
sums of the lengths of the parts and of the matches. Everything here is DataFrame
operations; no Python runs on the executors.

Defined results: a null text counts as empty; repeated rows each give a row with the same
spans; ids may be null or tied (a row is known by its id and the hash of its text); an
empty table gives an empty result; further columns are ignored, and kept by ``redact``, whatever
their names. A very long text is searched whole, in the task that holds its row; its matches, not
the text, are what is shuffled.
"""

from __future__ import annotations

import re
import re._parser as parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremill.llm.common import by_place, id_and_text, whole_text

#: Documents of one block of the index.
BLOCK_ROWS = 8192
#: Character classes up to this size are written out as alternatives.
SMALL_CLASS = 8
#: Alternatives of one rule before a part of the pattern is left out of the query.
MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share; matches whose ``group`` has
    fewer than ``least`` characters do not count."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
RULES = BASE_RULES + (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


# -- from a pattern to its trigram query ---------------------------------------------------

def _class_members(items) -> list[str] | None:
    out: list[str] = []
    for op, arg in items:
        if op is parser.LITERAL:
            out.append(chr(arg))
        elif op is parser.RANGE and arg[1] - arg[0] < SMALL_CLASS:
            out += [chr(c) for c in range(arg[0], arg[1] + 1)]
        else:
            return None
    return out if len(out) <= SMALL_CLASS else None


# An alternative is a tuple of literal runs that a match holds one after the other; None
# between runs stands for a gap of unknown text.
def _alternatives(nodes) -> list[tuple]:
    out: list[tuple] = [()]
    for op, arg in nodes:
        gap: list[tuple] = [(None,)]
        if op is parser.LITERAL:
            part = [(chr(arg),)]
        elif op is parser.IN:
            members = _class_members(arg)
            part = [(c,) for c in members] if members else gap
        elif op is parser.SUBPATTERN:
            part = _alternatives(arg[3])
        elif op is parser.BRANCH:
            part = [a for branch in arg[1] for a in _alternatives(branch)]
        elif op in (parser.MAX_REPEAT, parser.MIN_REPEAT):
            low, high, inner = arg
            once = _alternatives(inner)
            if (low, high) == (0, 1):
                part = [(), *once]
            elif low == 0:
                part = gap
            elif low == high and len(once) == 1:
                part = [once[0] * low]
            else:
                part = [(*a, None) for a in once]
        else:
            part = gap
        if len(out) * len(part) > MOST_ALTERNATIVES:
            part = gap
        out = [a + b for a in out for b in part]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of lower-case trigrams, one of which every match holds completely; None
    if some alternative has no trigram, so the query would let every text pass."""
    query = set()
    for alternative in _alternatives(parser.parse(pattern)):
        runs = "".join("\0" if c is None else c for c in alternative).lower().split("\0")
        grams = frozenset(r[i:i + 3] for r in runs for i in range(len(r) - 2) if r.isascii())
        if not grams:
            return None
        query.add(grams)
    return sorted((q for q in query if not any(o < q for o in query)), key=sorted)


# -- index, candidates, verification -------------------------------------------------------

def gates(alternatives: list[frozenset[str]]) -> dict[str, list[frozenset[str]]]:
    """Alternatives by one of their trigrams, as few different ones as a greedy choice finds: a text
    without it needs no test for the others."""
    rest, out = sorted(set(alternatives), key=sorted), {}
    while rest:
        count = {}
        for grams in rest:
            for t in grams:
                count[t] = count.get(t, 0) + 1
        gate = min(count, key=lambda t: (-count[t], t))
        out[gate] = [g for g in rest if gate in g]
        rest = [g for g in rest if gate not in g]
    return out


def postings(rows: DataFrame, alternatives: list[frozenset[str]], blocks: int) -> DataFrame:
    """The inverted index (block, trigram, docs) of ``rows`` (row_key, text) for the trigrams that the
    rules ask for. A text is listed under an alternative's trigrams if it holds their gate."""
    def held(gate: str, own: list[frozenset[str]]) -> Column:
        others = sorted(set().union(*own) - {gate})
        return F.when(F.contains("low", F.lit(gate)), F.array(F.lit(gate), *[
            F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in others]))

    lists = [F.coalesce(held(g, own), F.array().cast("array<string>")) for g, own in gates(alternatives).items()]
    return (rows.select("row_key", F.lower("text").alias("low"))
            .select("row_key", F.explode(F.array_compact(F.concat(*lists))).alias("trigram"))
            .groupBy(F.pmod("row_key", F.lit(blocks)).alias("block"), "trigram")
            .agg(F.collect_set("row_key").alias("docs")))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(row_key, kinds): the documents that a rule's query lets pass, from the postings."""
    listed = F.map_from_entries(F.collect_list(F.struct("trigram", "docs")))
    blocks = index.groupBy("block").agg(listed.alias("lists"))

    def docs(trigram: str) -> Column:
        return F.coalesce(F.try_element_at("lists", F.lit(trigram)), F.array().cast("array<bigint>"))

    passing = [F.struct(F.lit(kind).alias("kind"), reduce(F.array_union, [
        reduce(F.array_intersect, [docs(t) for t in sorted(grams)]) for grams in query]).alias("docs"))
        for kind, query in queries.items()]
    return (blocks.select(F.explode(F.array(*passing)).alias("hit"))
            .select(F.col("hit.kind").alias("kind"), F.explode("hit.docs").alias("row_key"))
            .groupBy("row_key").agg(F.collect_set("kind").alias("kinds")))


def _matches(rule: Rule, wanted: Column) -> Column:
    """The rule's matches in order: kind, nth, gap (characters since the match before), size
    (of the match), counts (whether it is long enough)."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    parts = F.arrays_zip(F.split(text, rule.pattern, -1),
                         F.regexp_extract_all(text, pattern, F.lit(0)),
                         F.regexp_extract_all(text, pattern, F.lit(rule.group)))
    found = F.transform(parts, lambda p, i: F.struct(
        F.lit(rule.kind).alias("kind"), i.cast("long").alias("nth"),
        F.length(p["0"]).cast("long").alias("gap"), F.length(p["1"]).cast("long").alias("size"),
        (F.length(p["2"]) >= rule.least).alias("counts")))
    found = F.filter(found, lambda m: m["size"].isNotNull())  # the part after the last match
    return F.when(wanted, found).otherwise(F.array().cast(
        "array<struct<kind:string,nth:bigint,gap:bigint,size:bigint,counts:boolean>>"))


def find_spans(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per different (id, text) of ``df`` with a match: doc_id, text_hash and spans, an array
    of (start, rank, end, kind) in order, where rank is the rule's place in ``rules``."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    rows = (id_and_text(df, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
            .withColumn("row_key", F.xxhash64("doc_id", "text_hash")))
    found = []
    full = [r for r in rules if not queries[r.kind]]
    if full:
        hits = [_matches(r, F.col("text").rlike(r.pattern if r.group or r.least < 2 or not r.pattern.endswith("+")
                                                else f"{r.pattern[:-1]}{{{r.least},}}")) for r in full]
        found.append(rows.select("doc_id", "text_hash", F.explode(F.concat(*hits)).alias("m")))
    if indexed:
        blocks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // BLOCK_ROWS))
        passed = candidates(postings(rows, [grams for q in indexed.values() for grams in q], blocks), indexed)
        hits = [_matches(r, F.array_contains("kinds", r.kind)) for r in rules if r.kind in indexed]
        found.append(rows.join(passed, "row_key")
                     .select("doc_id", "text_hash", F.explode(F.concat(*hits)).alias("m")))
    matches = (reduce(DataFrame.union, found).select("doc_id", "text_hash", "m.*")
               .repartition("doc_id", "text_hash")
               .dropDuplicates(["doc_id", "text_hash", "kind", "nth"]))
    so_far = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("nth")
    rank = F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)]), F.col("kind"))
    return (matches.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
            .where("counts")
            .groupBy("doc_id", "text_hash")
            .agg(F.sort_array(F.collect_list(F.struct(
                (F.col("end") - F.col("size")).alias("start"), rank.alias("rank"), "end", "kind"))).alias("spans")))


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id and spans (an empty array where nothing is found)."""
    rows = id_and_text(df, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"))
    found = find_spans(df, rules, id_col, text_col).select(
        F.col("doc_id").alias("at_id"), F.col("text_hash").alias("at_hash"), "spans")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return (rows.join(found, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("text_hash") == F.col("at_hash")),
                      "left")
            .select("doc_id", F.coalesce("spans", none).alias("spans")))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[REDACTED]") -> DataFrame:
    """``df`` (doc_id, text, ...) with every found span replaced by ``mark`` (overlapping spans
    by one) and, if there is such a column, n_chars of a changed text counted anew."""
    found = find_spans(df, rules).select(F.col("doc_id").alias("at_id"), F.col("text_hash").alias("at_hash"), "spans")
    own, name = by_place(df)
    text = whole_text(name["text"])
    joined = own.withColumn("own_hash", F.xxhash64(text)).join(
        found, F.col(name["doc_id"]).eqNullSafe(F.col("at_id")) & (F.col("own_hash") == F.col("at_hash")), "left")
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def cut(so_far: Column, span: Column) -> Column:
        before = F.substring(text, (so_far["at"] + 1).cast("int"),
                             F.greatest(span["start"] - so_far["at"], F.lit(0)).cast("int"))
        return F.struct(
            F.greatest(so_far["at"], span["end"]).alias("at"),
            F.concat(so_far["out"], before, F.when(span["start"] >= so_far["at"], F.lit(mark))
                     .otherwise(F.lit(""))).alias("out"))

    clean = F.aggregate("spans", state, cut, lambda s: F.concat(
        s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    changed = joined.withColumn("clean", F.when(F.col("spans").isNotNull(), clean))
    out = {c: F.col(c) for c in own.columns}
    out[name["text"]] = F.coalesce("clean", name["text"])
    if "n_chars" in name:
        c = name["n_chars"]
        out[c] = F.when(F.col("clean").isNotNull(), F.length("clean")).otherwise(F.col(c)).cast(own.schema[c].dataType)
    return changed.select(*out.values()).toDF(*df.columns)


def spans_of(text: str, rule: Rule) -> list[tuple[int, int]]:
    """The rule's spans in one text, by Python's own engine (for tests and spot checks)."""
    return [m.span() for m in re.finditer(rule.pattern, text) if len(m.group(rule.group)) >= rule.least]
