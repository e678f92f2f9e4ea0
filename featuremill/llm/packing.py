"""Packing (operator 6): documents into windows of a fixed number of tokens.

Each document's ids (with the end id) are cut into whole windows and a rest. The histogram of
piece lengths (at most ``window`` bins, whatever the data size) is brought to the driver,
where the plan is made:

1. enumerate shallow combinations of lengths whose sum is exactly the window (pairs, triples,
   and repeats of two frequent lengths with a third that fills up);
2. solve non-negative least squares for how often to repeat each combination so that together
   they use up the histogram;
3. round down, never using more pieces than there are;
4. pack what is left greedily, largest piece first, best fit.

The plan is a short list of (lengths, repeats). Each piece finds its place by arithmetic: its
rank among the pieces of its length, counted over all tasks, selects the repeat and the slot.
Full windows are a combination of their own. No piece is dropped, and ids are not moved.

Defined results: a null text counts as empty and gives the end id alone; repeated rows and
tied or null ids are separate documents; an empty table gives an empty result; further
columns are ignored. Memory: one Arrow batch and bounded memo tables per task, the histogram
and the plan (both bounded by the window) on the driver.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremill.llm.common import (MEMO_LIMIT, file_bytes, id_and_text, map_batches,
                                    public_path, single_threaded_tokenizers, stored)
from featuremill.llm.token_counts import CHUNK, SIMPLE, SIMPLE_PIECE, UNITS

WINDOW = 2048
#: Lengths whose repeats are combined with each other (the most frequent ones).
FREQUENT = 48
#: Most pieces of one repeated length in an enumerated combination.
REPEATS = 12
#: Steps of the least-squares solver.
STEPS = 400

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are kept as little-endian 32-bit numbers")


class PartIds(dict):
    """Part of a text -> its ids, filled when asked. Two generations of at most ``limit`` short
    parts are kept; entries not asked for during a whole generation are forgotten."""

    def __init__(self, make, limit: int, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest
        self.old: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        if len(part) > self.longest:  # not worth keeping, and of no bounded size
            return self.make(part)
        ids = self.old.get(part) or self.make(part)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[part] = ids
        return ids


class ChunkEncoder:
    """The tokenizer library on short parts of a text, with a bounded memo table.

    The byte-level pre-tokenizer always ends a piece before a run of white space that follows
    another character, so the ids of a text are those of its chunks, or, in texts of plain
    characters, of its pieces."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer
        single_threaded_tokenizers()
        self.library = Tokenizer.from_str(content.decode())
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        if any(len(CHUNK.findall(t)) != 1 or len(SIMPLE_PIECE.findall(t)) < 2 for t in special):
            raise ValueError("a special string that the cuts do not keep apart")
        self.merge = self.library.model.tokenize
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.ids_of = PartIds(self._ids, MEMO_LIMIT)

    def _cut(self, text: str) -> list[str]:
        if SIMPLE.fullmatch(text) and not (self.special and self.special.search(text)):
            return SIMPLE_PIECE.findall(text)
        return CHUNK.findall(text)

    def _ids(self, part: str) -> bytes:
        if SIMPLE.fullmatch(part) and len(SIMPLE_PIECE.findall(part)) == 1:
            found = [t.id for t in self.merge(part.translate(UNITS))]  # one piece already
        else:
            found = self.library.encode(part, add_special_tokens=False).ids
        return array("I", found).tobytes()

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text, one text at a time."""
        for text in texts:
            yield b"".join(map(self.ids_of.__getitem__, self._cut(text)))


_ENCODERS: dict[int, ChunkEncoder] = {}


def _encoder(content: bytes) -> ChunkEncoder:
    key = hash(content)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = ChunkEncoder(content)
    return _ENCODERS[key]


def token_pieces(df: DataFrame, window: int, tokenizer: str | None, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, and part and nth: the task
    that cut it and its number among that task's pieces of the same length."""
    model = df.sparkSession.sparkContext.broadcast(
        file_bytes(tokenizer or public_path("byte_bpe_50k.json")))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encoder = _encoder(model.value)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            row, start, length, crc, total, nth = [], [], [], [], [], []
            for i, ids in enumerate(encoder.encode_all(batch.column("text").to_pylist())):
                raw = memoryview(ids + end)
                n = len(raw) // 4
                for a in range(0, n, window):
                    size = min(window, n - a)
                    row.append(i)
                    start.append(a)
                    length.append(size)
                    crc.append(zlib.crc32(raw[4 * a:4 * (a + size)]))
                    total.append(n)
                    nth.append(int(seen[size]))
                    seen[size] += 1
            if row:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row, pa.int64())),
                     *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                     pa.array([part] * len(row), pa.int32()), pa.array(nth, pa.int64())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"])

    id_type = df.schema[id_col].dataType.simpleString()
    return id_and_text(df, id_col, text_col).mapInArrow(
        cut, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
             "part int, nth long")


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int) -> list[dict[int, int]]:
    """Shallow combinations (length -> pieces) that fill the window exactly."""
    have = set(lengths.tolist())
    order = lengths[np.argsort(-counts, kind="stable")].tolist()
    found: dict[tuple, dict[int, int]] = {}

    def add(*parts: tuple[int, int]) -> None:
        combo: dict[int, int] = {}
        for size, n in parts:
            combo[size] = combo.get(size, 0) + n
        found.setdefault(tuple(sorted(combo.items())), combo)

    for a in have:
        if window % a == 0:
            add((a, window // a))
        if window - a in have:
            add((a, 1), (window - a, 1))
    for a in have:  # a large piece, a frequent one and what fills up
        for b in order[:FREQUENT]:
            if window - a - b in have:
                add((a, 1), (b, 1), (window - a - b, 1))
    for x, a in enumerate(order[:FREQUENT]):
        for b in order[x:FREQUENT]:
            for i in range(1, min(REPEATS, window // a) + 1):
                for j in range(1, min(REPEATS, max(0, window - i * a) // b) + 1):
                    rest = window - i * a - j * b
                    if rest == 0:
                        add((a, i), (b, j))
                    elif rest in have:
                        add((a, i), (b, j), (rest, 1))
    return list(found.values())


def nonnegative_least_squares(combos: list[dict[int, int]], target: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 that brings sum of x times each combination close to ``target`` (indexed by
    length), by accelerated projected gradient steps on the sparse matrix of combinations."""
    if not combos:
        return np.zeros(0)
    column = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    size = np.array([s for c in combos for s in c])
    mult = np.array([float(m) for c in combos for m in c.values()])
    times = lambda x: np.bincount(size, mult * x[column], len(target))
    back = lambda r: np.bincount(column, mult * r[size], len(combos))
    v = np.ones(len(combos))
    for _ in range(20):  # the largest eigenvalue, for the step width
        w = back(times(v))
        v = w / np.linalg.norm(w)
    width = 1 / (1.05 * np.linalg.norm(back(times(v))))
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - width * back(times(y) - target))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan_windows(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[list[int], int]]:
    """(lengths in one window, repeats) that use up the histogram exactly."""
    left = np.zeros(window + 1, np.int64)
    for size, n in histogram.items():
        left[size] += n
    plan: list[tuple[list[int], int]] = []

    def use(combo: dict[int, int], most: int) -> None:
        n = min(most, *(int(left[s]) // m for s, m in combo.items()))
        if n > 0:
            for s, m in combo.items():
                left[s] -= n * m
            plan.append(([s for s in sorted(combo, reverse=True) for _ in range(combo[s])], n))

    use({window: 1}, int(left[window]))
    lengths = np.flatnonzero(left)
    combos = combinations(lengths, left[lengths], window)
    x = nonnegative_least_squares(combos, left.astype(float))
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 1:
            break
        use(combos[i], int(x[i]))
    while left.any():
        sizes = np.flatnonzero(left).tolist()
        combo, space, at = {}, window, len(sizes) - 1
        while at >= 0 and space:
            s = sizes[at]
            m = min(space // s, int(left[s]))
            if not combo:
                m = 1
            if m:
                combo[s] = combo.get(s, 0) + m
                space -= m * s
            at = min(at - 1, bisect_right(sizes, space) - 1)
        use(combo, int(left.max()))
    return plan


def pack(df: DataFrame, window: int = WINDOW, tokenizer: str | None = None, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = stored(token_pieces(df, window, tokenizer, end_id, id_col, text_col), "pieces")
    per_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r.length: r.n for r in
                 per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= window rows
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, repeats in plan_windows(histogram, window):
        offset = 0
        for size in lengths:  # ranks start, start + 1, ... take this slot in each repeat
            start = used.get(size, 0)
            slots.setdefault(size, []).append((start, sequence, offset))
            used[size] = start + repeats
            offset += size
        sequence += repeats
    places = df.sparkSession.sparkContext.broadcast(
        {size: np.array(own, np.int64) for size, own in slots.items()})
    before = per_task.select(
        "length", "part",
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = batch.column("length").to_numpy(zero_copy_only=False)
        rank = batch.column("rank").to_numpy(zero_copy_only=False)
        seq, off = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
        order = np.argsort(size, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            table = places.value[int(size[own[0]])]
            at = np.searchsorted(table[:, 0], rank[own], side="right") - 1
            seq[own] = table[at, 1] + rank[own] - table[at, 0]
            off[own] = table[at, 2]
        keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(seq), pa.array(off)],
                                          names=[*keep, "sequence_id", "offset"])

    ranked = (pieces.join(before, ["length", "part"])
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                      (F.col("before") + F.col("nth")).alias("rank")))
    id_type = df.schema[id_col].dataType.simpleString()
    return map_batches(ranked, place, f"doc_id {id_type}, start long, length long, ids_crc32 long, "
                                      "doc_tokens long, sequence_id long, offset long")
