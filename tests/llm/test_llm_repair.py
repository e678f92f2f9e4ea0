"""Operators 11 to 13 against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from odd_rows import none_at_all, odd  # noqa: F401
from featuremill.llm import cross_alignment, queries, turn_repair, vector_passes
from featuremill.llm.common import file_bytes, public_path

# -- operator 11 ------------------------------------------------------------------------------

GRAMMAR = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def plain_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))


def plain_faults(rows):
    seen, faults = set(), []
    for _, _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen
                      else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    return faults


def plain_repair(rows, faults):
    """All states by position and last initials written; the texts of the audits compared whole."""
    best = {"": (0, "", ())}  # "", "s", "u", "a" -> (cost, audit, written)
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def better(new, old):
        return old is None or new[:2] < old[:2]

    def inserted(front):
        front = dict(front)
        for _ in range(4):
            for state, (cost, audit, out) in list(front.items()):
                for x in "ua":
                    new = (cost + 5, audit + "I", out + ((x, "I", ""),))
                    if x in follow[state] and better(new, front.get(x)):
                        front[x] = new
        return front

    for (_, _, role, text), fault in zip(rows, faults):
        after = {}

        def put(state, new):
            if better(new, after.get(state)):
                after[state] = new

        for state, (cost, audit, out) in inserted(best).items():
            put(state, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            for x in "sua":
                if x in follow[state]:
                    if x == role[:1]:
                        put(x, (cost + more, audit + "K", out + ((role, "K", text),)))
                    elif x != "s":
                        put(x, (cost + more + 1, audit + "R", out + ((x, "R", text),)))
        best = after
    cost, audit, out = min((v for k, v in inserted(best).items() if k in ("", "a")), key=lambda v: v[:2])
    names = {"u": "user", "a": "assistant"}
    return cost, audit, "\n".join(f"{r if a == 'K' else names[r]}:{t}" for r, a, t in out)


def cheapest_by_trial(rows, faults, most=3):
    """Every edit sequence of few insertions, tried out (for very short conversations)."""
    found = []
    choices = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for f in faults]
    for own in itertools.product(*choices):
        for n in range(most + 1):
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
                for wrote in itertools.product("ua", repeat=n):
                    audit, spelt, cost = "", "", 5 * n
                    for i in range(len(rows) + 1):
                        for p, x in zip(places, wrote):
                            if p == i:
                                audit, spelt = audit + "I", spelt + x
                        if i < len(rows):
                            audit += own[i][0]
                            cost += {"D": 2, "K": 0, "R": 1}[own[i][0]]
                            if own[i] != "D":
                                cost += 5 if faults[i] == "truncated" else 0
                                spelt += (rows[i][2][:1] or "?") if own[i] == "K" else own[i][1]
                    if GRAMMAR.fullmatch(spelt):
                        found.append((cost, audit))
    return min(found)


def plain_rows(rows):
    out = {}
    ids = {r[0] for r in rows}
    damaged = plain_damage(rows)
    for conv in ids:
        own = plain_order([r for r in damaged if r[0] == conv])
        faults, turns = plain_faults(own), [r[1] for r in own if r[1] is not None]
        cost, audit, text = plain_repair(own, faults)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


TURNS = "conv_id long, turn long, role string, text string"


def some_turns(seed, conversations, most, roles=("user", "assistant", "system", "user ", None, "", "agent")):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", None, "Yes. ", "x", "1.", "ok ."]
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(r.randint(0, most)):
            row = (conv, r.choice([turn, turn, turn, None, 2 * turn]), r.choice(roles[:2] * 4 + roles), r.choice(texts)
                   if r.random() < 0.5 else f"text {r.randint(0, 2 * most)}.")
            rows += [row] * r.choice([1, 1, 1, 2])
    return rows


def as_rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_plain_repair_is_the_cheapest():
    for seed in range(150):
        own = plain_order(plain_damage([r for r in some_turns(seed, 0, 3)]))[:3]
        faults = plain_faults(own)
        assert plain_repair(own, faults)[:2] == cheapest_by_trial(own, faults)


def test_parser_spells_the_grammar():
    p = turn_repair.Parser()
    for n in range(7):
        for spelt in map("".join, itertools.product("sua", repeat=n)):
            stack = 0
            for x in spelt:
                stack = None if stack is None else p.shift.get((stack, x))
            assert (stack is not None and p.final[stack]) == bool(GRAMMAR.fullmatch(spelt)), spelt
    with pytest.raises(ValueError):
        turn_repair.Parser(turn_repair.Grammar(productions=(("S", ()), ("S", ("u", "S", "a")))))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_repair_against_plain(spark, partitions, monkeypatch, tmp_path):
    monkeypatch.setattr(turn_repair, "CHUNK", 4)
    rows = some_turns(partitions, 60, 9) + some_turns(99, 1, 300)[-200:]
    table = spark.createDataFrame(rows, TURNS)
    monkeypatch.setattr(queries, "read", lambda *_: table)
    damaged = queries.damaged_conversations(spark, "")
    assert sorted(map(str, plain_damage(rows))) == sorted(str(tuple(r)) for r in damaged.collect())
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = turn_repair.repair(damaged, table)
        assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                 "repaired_sha256"]
        assert as_rows(found) == plain_rows(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_long_conversation_over_many_ranges(spark):
    """One conversation that fills the table, alternating badly, with a text that repeats a lot."""
    r = random.Random(5)
    rows = [(7, i // 2, r.choice(["user", "assistant"]), r.choice(["same.", f"t{i}.", f"t{i}", ""])) for i in range(3000)]
    table = spark.createDataFrame(rows, TURNS).repartition(8)
    own = plain_order(rows)
    faults = plain_faults(own)
    plan = turn_repair.repair_plan(table, partitions=12).collect()
    assert len(plan) == 1
    assert (plan[0].cost, plan[0].audit) == plain_repair(own, faults)[:2]
    assert (plan[0].blank, plan[0].duplicate, plan[0].truncated) == tuple(
        faults.count(f) for f in ("blank", "duplicate", "truncated"))


def test_repair_odd_tables(spark):
    empty = spark.createDataFrame([], TURNS)
    assert turn_repair.repair(empty).collect() == []
    clash = spark.createDataFrame([(1, 0, "user", "Hi.", "k", 1, True), (1, 1, "assistant", "Ho.", "k", 1, True)],
                                  TURNS + ", key string, n int, audit boolean")
    out = turn_repair.repair(clash).collect()
    assert [(r.conv_id, r.cost, r.audit) for r in out] == [(1, 0, "KK")]
    gone = turn_repair.repair(clash.where("conv_id = 2"), clash).collect()
    assert [tuple(r) for r in gone] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_op11_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(queries.op11_turn_repair(spark, SF001)) == plain_rows(rows)


# -- operator 12 ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def aligner():
    return cross_alignment.Aligner(file_bytes(public_path("byte_bpe_50k.json")),
                                   file_bytes(public_path("piece_bpe_32k.model")))


def plain_alignment(aligner, text):
    """(n_a, n_b, n_groups, groups, links) by the libraries on the whole text and a set of ends."""
    none = (0, 0, 0, "", {})
    if not text:
        return none
    told = (" " + text).encode()
    a, b = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    ends = []
    for ids, raw in ((a, aligner.a_bytes), (b, aligner.b_bytes)):
        if b"".join(raw[i] for i in ids) != told:
            return none
        ends.append(list(itertools.accumulate(len(raw[i]) for i in ids)))
    groups, links, i, j = [], Counter(), 0, 0
    at_a, at_b = ({e: k + 1 for k, e in enumerate(own)} for own in ends)
    for cut in sorted(set(ends[0]) & set(ends[1])):
        groups.append(",".join(map(str, a[i:at_a[cut]])) + "|" + ",".join(map(str, b[j:at_b[cut]])))
        i, j = at_a[cut], at_b[cut]
        links[a[i - 1], b[j - 1]] += 1
    return len(a), len(b), len(groups), ";".join(groups), dict(links)


PIECES = [" ", "  ", "\n", "\n\n", "\t", "a", "The", "the ", "don't", "é", "日本語", " ", "　", "<|endoftext|>", "</s>",
          "<s>", "<0x41>", "👍🏽", "\x1c", "\r\n", "12345", "...", "password=", "  x", " \n", "́", "﷽", "\x00", "'s",
          " 's", "ﬁ", "A" * 70, ",", "foo", "bar.", "\n\nx", "e.g.", "x\ny", "A:", "é,", "\n.", "!\n", "▁"]


def test_aligner_against_the_libraries(aligner):
    r = random.Random(3)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    for text in [*texts, "", " ", "  ", "   ", "a ", "a  ", "x" * 5000, "ab c" * 4000]:
        got = aligner.text(text)
        links = {divmod(int(p), 1 << 32): int(n) for p, n in zip(got.pairs, got.times)}
        assert (got.n_a, got.n_b, got.n_groups, got.groups, links) == plain_alignment(aligner, text), repr(text[:200])


def test_align_ends():
    r = random.Random(4)
    for _ in range(500):
        size = r.randint(1, 60)
        a, b = (sorted({*r.sample(range(1, size + 1), r.randint(0, size)), size}) for _ in range(2))
        cuts = sorted(set(a) & set(b))
        assert cross_alignment.align(a, b) == [(a.index(c) + 1, b.index(c) + 1) for c in cuts]
    assert cross_alignment.align([], []) == []


def plain_quality(aligner, rows):
    told = [(i, plain_alignment(aligner, t)) for i, t in rows]
    count = Counter()
    for _, t in told:
        count.update(t[4])
    top = Counter()
    for (a, b), n in count.items():
        top[b] = max(top[b], n)
    return Counter((i, *t[:3], sum(t[4].values()), sum(n for p, n in t[4].items() if count[p] == top[p[1]]),
                    sum(n * count[p] for p, n in t[4].items()),
                    hashlib.sha256(t[3].encode()).hexdigest() if t[3] else "") for i, t in told)


def test_op12_on_the_table(spark, aligner):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, queries.op12_cross_alignment(spark, SF001).collect())) == plain_quality(aligner, rows)


def test_op12_odd_rows_and_many_pairs(spark, aligner, odd, none_at_all):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    want = plain_quality(aligner, rows)
    for most in (1, cross_alignment.PAIRS):  # joined by pair, and broadcast
        found = cross_alignment.alignment_quality(odd, most_pairs=most).select(*columns)
        assert Counter(map(tuple, found.collect())) == want
    assert cross_alignment.alignment_quality(none_at_all).collect() == []


# -- operator 13 ------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_links(rows, threshold=0.9):
    """(n_links, component) of each row, by all pairs."""
    sound = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    n = [0] * len(rows)
    for i, j in itertools.combinations(sound, 2):
        x, y = (np.array(rows[k][1], float) for k in (i, j))
        if len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
            n[i] += 1
            n[j] += 1
            parent[find(i)] = find(j)
    low = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            low[find(i)] = min(vec_id, low.get(find(i), vec_id))
    return Counter((vec_id, n[i], low.get(find(i)), vec_id == low.get(find(i))) for i, (vec_id, _) in enumerate(rows))


def some_vectors(seed, groups, size=16, spread=0.12):
    r = np.random.default_rng(seed)
    rows, number = [], 0
    for members in groups:
        centre = r.standard_normal(size)
        for _ in range(members):
            own = centre + spread * np.linalg.norm(centre) / math.sqrt(size) * r.standard_normal(size)
            rows.append((number, [float(np.float32(x)) for x in own]))
            number += 1
    return rows


def test_vectors_against_all_pairs(spark):
    rows = some_vectors(1, [1] * 150 + [2] * 20 + [40, 90])
    rows += [(500 + i, rows[3][1]) for i in range(30)]  # many copies of one vector
    rows += [(600, [2 * x for x in rows[4][1]]), (601, [1e-38 * x for x in rows[5][1]]), (602, None), (603, []),
             (604, [0.0] * 16), (605, [1.0, None] + [0.5] * 14), (606, [float("nan")] + [1.0] * 15),
             (607, [float("inf")] * 16), (None, rows[6][1]), (None, [5.0] + [0.0] * 15), (608, rows[7][1]),
             (608, rows[7][1]), (609, [1.0, 2.0]), (610, [1.0, 2.1])]
    table = spark.createDataFrame([(i, v, None) for i, v in rows], VECTORS).repartition(5)
    found = vector_passes.near_vectors(table, window=32)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert Counter(map(tuple, found.collect())) == plain_links(rows)


def test_windows_go_across_partitions(spark):
    """With windows as wide as the table every pair meets, whatever the partitions are."""
    rows = some_vectors(2, [3] * 60, spread=0.45)
    table = spark.createDataFrame([(i, v, None) for i, v in rows], VECTORS)
    want = plain_links(rows)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (1, 7, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            found = vector_passes.near_vectors(table, window=len(rows), passes=1)
            assert Counter(map(tuple, found.collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_links_counted_over_blocks(spark):
    rows = some_vectors(3, [70, 5, 1], spread=0.3)
    unit = vector_passes.unit_rows(np.array([v for _, v in rows]))
    of = [0] * 70 + [1] * 5 + [2]
    table = spark.createDataFrame([(c, i, [float(x) for x in u], 1 + i % 3) for c, (i, u) in zip(of, enumerate(unit))],
                                  "root long, node long, vec array<double>, n long")
    near = (unit @ unit.T >= 0.9) & (np.array(of)[:, None] == np.array(of)[None]) & ~np.eye(len(of), dtype=bool)
    want = {i: int(sum((1 + j % 3) for j in np.flatnonzero(near[i]))) for i in range(75)}
    for block in (1000, 16, 3):
        assert {r[0]: r[1] for r in vector_passes.count_links(table, block=block).collect()} == want


def test_recall_of_the_passes(spark):
    """Pairs near the threshold among vectors that link with nothing else."""
    r = np.random.default_rng(8)
    base = vector_passes.unit_rows(r.standard_normal((6000, 64)))
    other = vector_passes.unit_rows(r.standard_normal((6000, 64)))
    other -= (base * other).sum(axis=1, keepdims=True) * base
    other = vector_passes.unit_rows(other)
    cosine = r.uniform(0.9, 0.93, 500)[:, None]
    near = cosine * base[:500] + np.sqrt(1 - cosine ** 2) * other[:500]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(np.concatenate([base, near]))]
    found = {x.vec_id: x for x in vector_passes.near_vectors(spark.createDataFrame(rows, VECTORS.replace("float", "double")),
                                                             window=32).collect()}
    met = sum(found[6000 + i].component_id == i for i in range(500))
    assert met >= 450, met
    assert all(x.n_links <= 1 for x in found.values())


def test_vectors_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert vector_passes.near_vectors(empty).collect() == []
    clash = spark.createDataFrame([(1, [1.0, 0.0], "n", "r", 2), (2, [1.0, 0.01], "n", "r", 2)],
                                  "vec_id long, embedding array<double>, node string, root string, links int")
    assert sorted(map(tuple, vector_passes.near_vectors(clash).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]
    one = vector_passes.near_vectors(spark.createDataFrame([(1, None, 0)], VECTORS)).select(F.col("kept")).collect()
    assert one[0].kept
