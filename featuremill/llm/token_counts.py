"""Token counts (operator 7): the exact number of byte-level BPE tokens of every prefix.

``token_prefix_counts`` stores, for each document, the token count of every prefix of its
text (by code points), each equal to what encoding that prefix alone would give. From the
stored table ``count_at`` and ``longest_within`` answer truncation and budget questions
without encoding again.

Method. The library's own pre-tokenizer cuts a text into pieces; inside a piece the counts
of all prefixes come from dynamic programming (``prefix_merge``). Three prefixes do not end
as the whole text's pieces do and are counted as they stand alone: one that ends after a
run of white space (the run is then one piece), one inside a contraction such as ``'re``,
and one inside a special string. Texts are cut before each run of white space, where a piece
always ends, and the result of each such chunk is kept in a bounded memo table.

Defined results: a null text counts as empty (0 tokens, an empty table); repeated rows and
tied or null ids each give their own row; an empty table gives an empty result; further
columns are ignored. Memory per task: one Arrow batch plus the bounded memo tables.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from featuremill.llm.common import (MEMO_LIMIT, file_bytes, id_and_text, map_batches,
                                    public_path, single_threaded_tokenizers)
from featuremill.llm.prefix_merge import Memo, MergeTable

# Unicode White_Space, the class that the pre-tokenizer's \s stands for.
SPACE = "\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
RUN = re.compile(f"[{SPACE}]*")
# Texts of these characters alone, without adjacent white space, are cut without the library
# (no apostrophe, which starts the contractions).
LETTERS, DIGITS, SIGNS = "A-Za-zÀ-ÖØ-öø-ſ", "0-9", r"!-&(-/:-@\[-`{-~"
SIMPLE = re.compile(f"(?:[ \n]?[{LETTERS}{DIGITS}{SIGNS}]++)*+[ \n]?")
SIMPLE_PIECE = re.compile(f" ?[{LETTERS}]+| ?[{DIGITS}]+| ?[{SIGNS}]+|[ \n]")
#: Contractions that the pre-tokenizer keeps whole and whose two-character prefix it splits.
CONTRACTIONS = ("'re", "'ve", "'ll")


def _byte_units() -> list[str]:
    """The vocabulary's character for each byte: printable Latin-1 characters stand for
    themselves, the rest for the code points from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


UNITS = {c: "".join(_byte_units()[b] for b in chr(c).encode()) for c in range(384)}


class PrefixCounter:
    """Prefix counts of one byte-level BPE vocabulary (content of a tokenizer .json file)."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer
        single_threaded_tokenizers()
        spec = json.loads(content)
        self.pieces_of = Tokenizer.from_str(content.decode()).pre_tokenizer.pre_tokenize_str
        merges = {tuple(m if isinstance(m, list) else m.split(" ")): r
                  for r, m in enumerate(spec["model"]["merges"])}
        vocab = {t: i for t, i in spec["model"]["vocab"].items()}
        self.merge = MergeTable(vocab, lambda a, b: merges.get((a, b)))
        if self.merge.longest > 128:
            raise ValueError("a delta of the stored table must fit one signed byte")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = (re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))))
                        if self.specials else None)
        self._chunks, self._pieces = Memo(MEMO_LIMIT), Memo(MEMO_LIMIT)

    def _piece(self, text: str, units: str | None = None) -> bytes:
        """Differences between the counts of successive prefixes of one piece, at its code
        points; ``units`` is the piece in the vocabulary's alphabet, one unit per byte."""
        if units is None:
            units = text.translate(UNITS)
        counts = self.merge.table(units)[1]
        if text in CONTRACTIONS:
            return bytes([1, 1, (counts[-1] - 2) & 255])
        if len(units) != len(text):
            at, own = -1, []
            for c in text:
                at += len(c.encode())
                own.append(counts[at])
            counts = own
        return bytes([(b - a) & 255 for a, b in zip([0, *counts], counts)])

    def _chunk(self, chunk: str) -> bytes:
        """Differences between the counts of successive prefixes of a chunk."""
        deltas = b"".join([self._piece(chunk[a:b], units) for units, (a, b) in self.pieces_of(chunk)])
        run = RUN.match(chunk).end()
        if 2 <= run < len(chunk):
            # a prefix that ends with the run of white space has the run as one piece
            (units, _), = self.pieces_of(chunk[:run])
            signed = np.frombuffer(deltas, np.int8).astype(np.int64)
            after = int(signed[:run + 1].sum())
            signed[:run] = np.frombuffer(self._piece(chunk[:run], units), np.int8)
            signed[run] = after - int(signed[:run].sum())
            deltas = signed.astype(np.int8).tobytes()
        return deltas

    def _plain(self, text: str) -> bytes:
        if SIMPLE.fullmatch(text):
            parts, memo, make = SIMPLE_PIECE.findall(text), self._pieces, self._piece
        else:
            parts, memo, make = CHUNK.findall(text), self._chunks, self._chunk
        new, out = memo.new, []
        for part in parts:
            deltas = new.get(part)
            if deltas is None:
                deltas = memo.missed(part, make) if len(part) <= 64 else make(part)
            out.append(deltas)
        return b"".join(out)

    def table(self, text: str) -> bytes:
        """One signed byte per code point: the change of the count from the prefix before."""
        found = self.special.search(text) if self.special else None
        if not found:
            return self._plain(text)
        out, at = [], 0
        while found:
            # up to its last character a special string is ordinary text; with it, it is one token
            part = self._plain(text[at:found.end() - 1])
            before = int(np.frombuffer(part[:found.start() - at], np.int8).sum(dtype=np.int64))
            inside = int(np.frombuffer(part, np.int8).sum(dtype=np.int64))
            out += [part, np.int8(before + 1 - inside).tobytes()]
            at = found.end()
            found = self.special.search(text, at)
        out.append(self._plain(text[at:]))
        return b"".join(out)


def prefix_counts(table: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2, ... code points."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(table, np.int8), dtype=np.int64)])


def count_at(table: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` code points."""
    return int(np.frombuffer(table, np.int8, count=min(n_chars, len(table))).sum(dtype=np.int64))


def longest_within(table: bytes, budget: int) -> int:
    """Code points of the longest prefix that has at most ``budget`` tokens."""
    return int(np.flatnonzero(prefix_counts(table) <= budget)[-1]) if budget >= 0 else 0


_COUNTERS: dict[int, PrefixCounter] = {}


def _counter(content: bytes) -> PrefixCounter:
    key = hash(content)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PrefixCounter(content)
    return _COUNTERS[key]


def token_prefix_counts(df: DataFrame, tokenizer: str | None = None, budget: int = 1024,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id, n_bytes, n_chars, n_tokens, fit_chars (the longest prefix
    within ``budget`` tokens) and prefix_counts, the stored table (see ``count_at``)."""
    model = df.sparkSession.sparkContext.broadcast(
        file_bytes(tokenizer or public_path("byte_bpe_50k.json")))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = _counter(model.value)
        rows = []
        for text in batch.column("text").to_pylist():
            table = counter.table(text)
            counts = prefix_counts(table)
            total = int(counts[-1])
            fit = len(table) if counts.max() <= budget else int(np.flatnonzero(counts <= budget)[-1])
            rows.append((len(text.encode()), len(text), total, fit, table))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]),
             pa.array(cols[4], pa.binary())],
            names=["doc_id", "n_bytes", "n_chars", "n_tokens", "fit_chars", "prefix_counts"])

    id_type = df.schema[id_col].dataType.simpleString()
    return map_batches(id_and_text(df, id_col, text_col), count,
                       f"doc_id {id_type}, n_bytes long, n_chars long, n_tokens long, "
                       "fit_chars long, prefix_counts binary")
