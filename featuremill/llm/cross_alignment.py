"""Cross-tokenizer alignment (operator 12): divide and conquer at shared cuts.

A text is encoded by two tokenizers, and the byte offsets where tokens of both end cut its
tokens into groups. ``align`` finds them on the two lists of token ends: it looks outwards
from the middle of an interval for an end that bisection finds in the other list too, cuts
there, and goes on with both halves; an interval without a shared end is one group.

Whole texts are cut first at shared ends that are known without encoding: neither tokenizer
has a token across a place where a space follows another character, around a single line feed
between such characters, or between a Latin letter and a punctuation mark (checked on the models
when they are loaded), so each such part is encoded and aligned by itself and its groups are kept
in a bounded memo table. A link joins the two tokens that end a group.

How often an id pair is linked is counted over the whole corpus: links are combined per
document, then per task, then by pair. The pair table has at most one row for each pair of
vocabulary entries; it is broadcast only if it has at most ``PAIRS`` rows, and is otherwise
joined by pair, with the pairs that hold much of the corpus salted.

Defined results: a null or empty text, and one whose tokens do not spell it (for example
because it holds U+2581, which the second tokenizer reads as a space), has no tokens, no
groups and zeros; tied or null ids and repeated rows each give their own row, and each counts;
an empty table gives an empty result; further columns are ignored. Memory per task: one Arrow
batch, one text's tokens, and the memo tables.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_left
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremill.llm.common import (MEMO_LIMIT, file_bytes, id_and_text, map_batches, public_path,
                                    single_threaded_tokenizers, stored)
from featuremill.llm.piece_codec import LETTERS, MARK
from featuremill.llm.prefix_merge import Memo
from featuremill.operators.skew import salted_left_join

#: Where a text may be cut before it is encoded.
CUT = f"(?<=\\S)(?= )|(?<=\\S)(?=\\n\\S)|(?<=\\S\\n)(?=\\S)|(?<=[{LETTERS}])(?=[.,;:!?])"
#: The parts, which begin and end at such places: the usual ones first, then any.
PART = re.compile(f"\\n(?=\\S)| ?[{LETTERS}]+(?=[.,;:!?])| ?\\S+(?= |\\n\\S|\\Z)|(?s:.(?:(?!{CUT}).)*)")
#: What no piece of the second tokenizer may hold, for the cuts to be shared ends.
ACROSS = re.compile(f"[^{MARK}]{MARK}|\n|[{LETTERS}][.,;:!?]")
#: A part that the first tokenizer takes as one piece.
WORD = re.compile(" ?[A-Za-z]+")
#: Marks a part's token numbers among its links.
NUMBERS = 1 << 62
#: Parts up to this length are kept in the memo table.
LONGEST = 64
#: Rows of the pair table up to which it is broadcast (about 24 bytes each).
PAIRS = 2_000_000


def align(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int]]:
    """The groups' ends as (number of first tokens, number of second tokens), in order.
    ``a_ends``, ``b_ends``: ascending byte offsets of the tokens' ends, of one text."""
    done, todo = [], [(0, len(a_ends), 0, len(b_ends))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a1 - a0 > 1 and b1 - b0 > 1:
            cut = _shared_end(a_ends, a0, a1 - 1, b_ends, b0, b1 - 1)
            if cut is not None:
                a, b = cut
                todo.append((a, a1, b, b1))  # the left half is taken up first
                todo.append((a0, a, b0, b))
                continue
        if a1 > a0 or b1 > b0:
            done.append((a1, b1))
    return done


def _shared_end(a_ends, a0: int, a1: int, b_ends, b0: int, b1: int) -> tuple[int, int] | None:
    """The shared end next to the middle of a_ends[a0:a1], as the numbers of tokens up to it."""
    middle = (a0 + a1) // 2
    for step in range(max(middle - a0, a1 - 1 - middle) + 1):
        for at in ((middle,) if not step else (middle - step, middle + step)):
            if a0 <= at < a1:
                b = bisect_left(b_ends, a_ends[at], b0, b1)
                if b < b1 and b_ends[b] == a_ends[at]:
                    return at + 1, b + 1
    return None


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for themselves, the
    others for the characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligned(NamedTuple):
    """A text's token numbers, its groups (``a1,a2|b1;a3|b2,b3``), and its links: the different id
    pairs as a << 32 | b, ascending, and how often each is linked."""
    n_a: int
    n_b: int
    groups: str
    pairs: np.ndarray
    times: np.ndarray

    @property
    def n_groups(self) -> int:
        return int(self.times.sum())


NONE = Aligned(0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))


class Aligner:
    """Two tokenizers (contents of a tokenizers .json and a SentencePiece .model file)."""

    def __init__(self, a_content: bytes, b_content: bytes):
        import sentencepiece
        from tokenizers import Tokenizer
        single_threaded_tokenizers()
        before = json.loads(a_content).get("pre_tokenizer") or {}
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("not a byte-level tokenizer with its own cuts")
        self.a = Tokenizer.from_str(a_content.decode())
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.merge = self.a.model.tokenize
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_content)
        to_byte = byte_alphabet()
        self.space = next(c for c, b in to_byte.items() if b == 32)
        self.a_bytes = {i: bytes(map(to_byte.__getitem__, t)) for t, i in self.a.get_vocab(with_added_tokens=False).items()
                        if all(c in to_byte for c in t)}
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if not self.b.is_byte(i) and ACROSS.search(piece):
                raise ValueError(f"the piece {piece!r} spans what is cut")
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace(MARK, " ").encode())
        self.parts = Memo(MEMO_LIMIT)

    def tokens(self, part: str) -> tuple[list[int], list[int]]:
        """Both tokenizers' ids of a part."""
        if WORD.fullmatch(part):
            a = [t.id for t in self.merge(part.replace(" ", self.space))]
        else:
            a = self.a.encode(part, add_special_tokens=False).ids
        # the second tokenizer puts a space before what it is given; a line feed, which joins
        # with nothing, keeps that space apart where the part has none
        return a, self.b.encode(part[1:]) if part[0] == " " else self.b.encode("\n" + part)[2:]

    def part(self, part: str) -> tuple[str, bytes] | None:
        """The groups of a part, and 64-bit numbers: its token numbers and then its links; None if
        the tokens do not spell the part."""
        a, b = self.tokens(part)
        a_raw, b_raw = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if not b"".join(a_raw) == b"".join(b_raw) == part.encode():
            return None
        groups, told, a0, b0 = [], array("q", [NUMBERS | len(a) << 31 | len(b)]), 0, 0
        for a1, b1 in align(list(accumulate(map(len, a_raw))), list(accumulate(map(len, b_raw)))):
            if a1 - a0 == b1 - b0 == 1:
                groups.append(f"{a[a0]}|{b[b0]}")
            else:
                groups.append(f"{','.join(map(str, a[a0:a1]))}|{','.join(map(str, b[b0:b1]))}")
            told.append(a[a1 - 1] << 32 | b[b1 - 1])
            a0, b0 = a1, b1
        return ";".join(groups), told.tobytes()

    def cut(self, text: str) -> list[str]:
        """Space and text, cut where no token of either tokenizer crosses."""
        parts = PART.findall(" " + text)
        if len(parts) > 1 and not parts[-1].strip(" "):
            parts[-2:] = ["".join(parts[-2:])]  # a part of spaces alone would be encoded otherwise
        return parts

    def text(self, text: str) -> Aligned:
        """The whole text's tokens, groups and links."""
        if not text or MARK in text:
            return NONE
        parts = self.cut(text)
        found = list(map(self.parts.new.get, parts))
        for i, (part, own) in enumerate(zip(parts, found)):
            if own is None:
                own = self.parts.missed(part, self._told) if len(part) <= LONGEST else self._told(part)
                found[i] = own
            if own is False:
                return NONE
        told = np.frombuffer(b"".join([own[1] for own in found]), np.int64)
        numbers = told >= NUMBERS
        pairs, times = np.unique(told[~numbers], return_counts=True)
        n = told[numbers] ^ NUMBERS
        return Aligned(int((n >> 31).sum()), int((n & ((1 << 31) - 1)).sum()), ";".join([own[0] for own in found]),
                       pairs, times)

    def _told(self, part: str):
        return self.part(part) or False


_ALIGNERS: dict[int, Aligner] = {}


def aligner(a_content: bytes, b_content: bytes) -> Aligner:
    """One aligner per worker process, however many batches and tasks it runs."""
    key = hash((a_content, b_content))
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(a_content, b_content)
    return _ALIGNERS[key]


def align_documents(df: DataFrame, a_path: str | None = None, b_path: str | None = None, digest: bool = False,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id, n_a, n_b, n_groups, groups (``a1,a2|b1;a3|b2,b3`` in ids; with
    ``digest`` its SHA-256, or the empty text where there is no group) and links, an array of
    (a, b, n): the linked id pairs and how often the text links them."""
    spark = df.sparkSession
    a = spark.sparkContext.broadcast(file_bytes(a_path or public_path("byte_bpe_50k.json")))
    b = spark.sparkContext.broadcast(file_bytes(b_path or public_path("piece_bpe_32k.model")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = aligner(a.value, b.value)
        told, sizes, pairs, times = [], [0], [NONE.pairs], [NONE.times]
        for text in batch.column("text").to_pylist():
            t = own.text(text)
            groups = hashlib.sha256(t.groups.encode()).hexdigest() if digest and t.groups else t.groups
            told.append((t.n_a, t.n_b, t.n_groups, groups))
            sizes.append(sizes[-1] + len(t.pairs))
            pairs.append(t.pairs)
            times.append(t.times)
        n_a, n_b, n_groups, groups = zip(*told)
        pair = np.concatenate(pairs)
        links = [pa.array(x.astype(np.int32)) for x in (pair >> 32, pair & 0xFFFFFFFF, np.concatenate(times))]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
             pa.array(n_groups, pa.int64()), pa.array(groups, pa.string()),
             pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(links, ["a", "b", "n"]))],
            names=["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])

    id_type = df.schema[id_col].dataType.simpleString()
    return map_batches(id_and_text(df, id_col, text_col), run,
                       f"doc_id {id_type}, n_a long, n_b long, n_groups long, groups string, "
                       "links array<struct<a:int,b:int,n:int>>")


def pair_counts(links: DataFrame) -> DataFrame:
    """(a, b, count, best) for ``links`` (a, b, n): how often the corpus links the pair, and
    whether no other pair of the same b is linked more often."""
    counts = links.groupBy("a", "b").agg(F.sum("n").alias("count"))
    top = F.max("count").over(Window.partitionBy("b"))
    return counts.withColumn("best", F.col("count") == top)


def alignment_quality(df: DataFrame, digest: bool = True, most_pairs: int = PAIRS, id_col: str = "doc_id",
                      text_col: str = "text", **paths) -> DataFrame:
    """``align_documents`` without the links, and per row n_links, n_best (links whose pair is
    linked most often among the pairs of its second id) and count_sum (corpus counts of the
    pairs, summed over the links)."""
    docs = stored(align_documents(df, digest=digest, id_col=id_col, text_col=text_col, **paths)
                  .withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = docs.select("row", F.explode("links").alias("l")).select("row", "l.a", "l.b", "l.n")
    pairs = stored(pair_counts(links), "linked-pairs")
    if pairs.count() <= most_pairs:
        met = links.join(F.broadcast(pairs), ["a", "b"], "left")
    else:
        met = salted_left_join(links, pairs, ["a", "b"], ["row"])
    sums = met.groupBy("row").agg(
        F.sum("n").alias("n_links"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum")).withColumnRenamed("row", "of")
    return (docs.join(sums, F.col("row") == F.col("of"), "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "groups",
                    *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]))
