"""Quality rules (operator 3): repetition coverage.

For several lengths n the rolling hashes of a text's word n-grams are computed in numpy and
the characters of all words inside n-grams found twice or more are measured (each word
once, first occurrences included), as are the characters in repeated lines and those of the
one word that covers most. Equal hashes are compared word by word, so a hash collision
cannot count.

A document fails if it has fewer than 10 words, if more than a fifth of its words lie in
repeated 5-grams, or if one of the coverages exceeds its limit. The limits lie above what the
documents labelled good have, in the rows that are not kept for testing (``README``).

Defined results: a null text has no words (and fails); repeated rows and tied or null ids
each give their own row; an empty table gives an empty result; further columns are ignored
(``keep_good`` returns them unchanged). Memory per task: one Arrow batch, and about 100 bytes
per word of the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from featuremill.llm.common import id_and_text, map_batches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
#: Largest share of the word characters inside repeated n-grams, by n.
LIMITS = {2: 0.30, 3: 0.30, 4: 0.30, 5: 0.30, 6: 0.29, 7: 0.28, 8: 0.27, 9: 0.26, 10: 0.25}
#: Largest share of one word, found so often or more, in the word characters.
WORD_LIMIT, WORD_TIMES = 0.10, 10
#: Largest share of the word characters in lines that occur more than once.
LINE_LIMIT = 0.50
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = (ids + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def repeated_starts(ids: np.ndarray, n: int, hashes: np.ndarray) -> np.ndarray:
    """Starts of the n-grams that occur more than once. ``hashes``: their rolling hashes."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    a = np.flatnonzero(ordered[1:] == ordered[:-1])
    if not len(a):
        return a
    left, right = order[a], order[a + 1]
    if all((ids[left + j] == ids[right + j]).all() for j in range(n)):
        mark = np.zeros(len(hashes), bool)
        mark[left] = mark[right] = True
        return np.flatnonzero(mark)
    grams = np.lib.stride_tricks.sliding_window_view(ids, n)  # a collision: compare the words themselves
    _, inverse, counts = np.unique(grams, axis=0, return_inverse=True, return_counts=True)
    return np.flatnonzero(counts[inverse.ravel()] > 1)


def coverage(ids: np.ndarray, lengths) -> Iterator[tuple[int, np.ndarray]]:
    """(n, mask of the words inside repeated n-grams) for increasing n."""
    word = _mixed(ids)
    hashes = word
    none = False
    for n in range(1, max(lengths) + 1):
        if n > 1 and not none and len(hashes) > 1:
            hashes = hashes[:-1] * FACTOR + word[n - 1:]
        if n not in lengths:
            continue
        covered = np.zeros(len(ids), bool)
        if not none and len(ids) > n:
            starts = repeated_starts(ids, n, hashes)
            none = not len(starts)  # a repeated longer n-gram would hold a repeated shorter one
            if not none:
                edge = np.zeros(len(ids) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + n, -1)
                covered = np.cumsum(edge[:-1]) > 0
        yield n, covered


def measure(text: str) -> dict:
    """All figures of one text, and the verdict."""
    words = WORD.findall(text)
    size = np.fromiter(map(len, words), np.int64, len(words))
    word_chars = int(size.sum())
    seen: dict[str, int] = {}
    number = count()
    ids = np.fromiter((seen[w] if w in seen else seen.setdefault(w, next(number)) for w in words),
                      np.uint64, len(words))
    often = np.bincount(ids.astype(np.int64)) >= WORD_TIMES
    word_share = float((np.bincount(ids.astype(np.int64), size) * often).max()) / word_chars if word_chars else 0.0
    share, n_repeat = {}, 0
    for n, covered in coverage(ids, LIMITS):
        share[n] = float(size[covered].sum()) / word_chars if word_chars else 0.0
        if n == 5:
            n_repeat = int(covered.sum())
    lines: dict[str, int] = {}
    n_dup_lines = 0
    for line in text.split("\n"):
        if line in lines:
            lines[line] += 1
            n_dup_lines += 1
        elif WORD.search(line):
            lines[line] = 1
    line_chars = sum(n * sum(map(len, WORD.findall(line))) for line, n in lines.items() if n > 1)
    line_share = line_chars / word_chars if word_chars else 0.0
    failed = len(words) < 10 or 100 * n_repeat > 20 * len(words)
    kept = (not failed and line_share <= LINE_LIMIT and word_share <= WORD_LIMIT
            and all(share[n] <= m for n, m in LIMITS.items()))
    return {"n_words": len(words), "word_chars": word_chars, "n_symbols": len(SYMBOL.findall(text)),
            "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat, "base_failed": failed, "kept": kept,
            "line_coverage": line_share, "word_coverage": word_share, **{f"coverage_{n}": share[n] for n in LIMITS}}


FIELDS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
          "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean",
          "line_coverage": "double", "word_coverage": "double", **{f"coverage_{n}": "double" for n in LIMITS}}


def repetition_coverage(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id and the figures of ``measure``."""
    types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([r[f] for r in rows], types[t]) for f, t in FIELDS.items())],
            names=["doc_id", *FIELDS])

    id_type = df.schema[id_col].dataType.simpleString()
    return map_batches(id_and_text(df, id_col, text_col), scan,
                       f"doc_id {id_type}, " + ", ".join(f"{f} {t}" for f, t in FIELDS.items()))


def keep_good(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that pass, with all their columns."""
    at = df.columns.index(text_col)

    def passing(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([measure(t or "")["kept"] for t in batch.column(at).to_pylist()]))

    return map_batches(df, passing, df.schema)
