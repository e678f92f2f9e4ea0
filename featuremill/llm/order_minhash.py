"""Document fingerprints (operator 1): Order MinHash.

A text is taken as its k-mers (of code points), each numbered by occurrence, so that repeats
differ. For each of ``hashes`` hash functions the ``tuple_size`` k-mers of smallest hash are
selected, put back into text order and hashed together: two texts agree in an entry only if
they share these k-mers in the same order, which follows the edit distance where plain
MinHash follows the set of k-mers only.

``neighbour_likeness`` compares each document with the next one by id and with an edited
form of itself. Documents are range-partitioned by id and streamed in order, one row held at
a time; only the first and last document of each partition take part in a second, small step
that joins neighbouring partitions.

Defined results: a null text counts as empty; the empty text has an all-zero fingerprint,
like only to itself; a text shorter than k is one k-mer; among equal ids the order is by
text hash (null ids come first); repeated rows are separate documents; a table of one row
has itself as next document; an empty table gives an empty result; further columns are
ignored. Memory per task: one Arrow batch and about 64 bytes per code point of a text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremill.llm.common import id_and_text, stored

K = 12
HASHES = 32
TUPLE_SIZE = 2
#: k-mers from which on the hash functions are evaluated one at a time (bounds memory).
WIDE = 1 << 15

BASE, A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                                        0xD6E8FEB86659FD93))
S1, S2 = np.uint64(29), np.uint64(32)
A32, B32, S15 = np.uint32(0x2C1B3C6D), np.uint32(0x297A2D39), np.uint32(15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> S1)) * A
    return (x ^ (x >> S2)) * B


def kmer_hashes(text: str, k: int) -> np.ndarray:
    """Polynomial hashes of all k-mers, by doubling (a text shorter than k is one k-mer)."""
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + C
    k = min(k, len(h))
    power, size, out, done = BASE, 1, None, 0
    while k:
        if k & 1:  # append runs of 1, 2, 4, ... characters
            if out is None:
                out, done = h, size
            else:
                n = min(len(out), len(h) - done)
                out = out[:n] * power + h[done:done + n]
                done += size
        k >>= 1
        if k:
            h = h[:-size] * power + h[size:]
            power, size = power * power, size * 2
    return mix(out)


def occurrence_numbers(h: np.ndarray) -> np.ndarray:
    """For each entry, how many equal entries come before it."""
    number = np.zeros(len(h), np.uint64)
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        at = np.searchsorted(twice, h)
        own = np.flatnonzero(twice[np.minimum(at, len(twice) - 1)] == h)
        order = own[np.argsort(h[own], kind="stable")]
        starts = np.flatnonzero(np.concatenate([[True], h[order[1:]] != h[order[:-1]]]))
        number[order] = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return number


class OrderMinHash:
    def __init__(self, k: int = K, hashes: int = HASHES, tuple_size: int = TUPLE_SIZE, seed: int = 1):
        self.k, self.hashes, self.tuple_size = k, hashes, tuple_size
        with np.errstate(over="ignore"):
            self.seeds = mix(np.arange(1, hashes + 1, dtype=np.uint64) * C + np.uint64(seed))

    def signature(self, text: str) -> np.ndarray:
        """``hashes`` unsigned 32-bit entries; all zero for the empty text only."""
        if not text:
            return np.zeros(self.hashes, np.uint32)
        with np.errstate(over="ignore"):
            kmer = kmer_hashes(text, self.k)
            numbered = (mix(kmer + occurrence_numbers(kmer) * C) >> S2).astype(np.uint32)
            if len(kmer) > WIDE:
                picked = np.vstack([self._smallest(numbered, self.seeds[j:j + 1]) for j in range(self.hashes)])
            else:
                picked = self._smallest(numbered, self.seeds)
            picked.sort(axis=1)  # text order
            out = self.seeds.copy()
            for i in range(picked.shape[1]):
                out = mix(out * BASE + kmer[picked[:, i]])
            return (out >> S2).astype(np.uint32) | np.uint32(1)

    def _smallest(self, x: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        """Positions of the smallest ``tuple_size`` hashed entries under each seed."""
        h = x[None, :] ^ (seeds >> S2).astype(np.uint32)[:, None]
        h *= A32
        h ^= h >> S15
        h *= B32
        h ^= h >> S15
        rows = np.arange(len(seeds))
        picked = []
        for _ in range(min(self.tuple_size, len(x))):
            at = h.argmin(axis=1)
            h[rows, at] = np.iinfo(np.uint32).max
            picked.append(at)
        return np.stack(picked, axis=1)


def as_text(signature: np.ndarray) -> str:
    """Lowercase hexadecimal, 8 digits an entry."""
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal entries."""
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the start of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """Per row of ``df``: doc_id and fingerprint."""
    own = OrderMinHash(**settings)

    def scan(batches):
        for batch in batches:
            prints = [as_text(own.signature(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())],
                                             names=["doc_id", "fingerprint"])

    id_type = df.schema[id_col].dataType.simpleString()
    return id_and_text(df, id_col, text_col).mapInArrow(scan, f"doc_id {id_type}, fingerprint string")


RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compare(own: OrderMinHash, text: str, signature, following: str, next_signature) -> tuple:
    other = edited(text, following)
    changed = own.signature(other)
    return (len(text), hashlib.sha256(other.encode()).hexdigest(), as_text(signature), as_text(changed),
            likeness(signature, changed), likeness(signature, next_signature))


def neighbour_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       partitions: int | None = None, **settings) -> DataFrame:
    """Per row of ``df``, in ascending order of id: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The next document of the last is the first."""
    own = OrderMinHash(**settings)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_type = df.schema[id_col].dataType.simpleString()
    fields = (f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    arrow = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def walk(batches):
        part = TaskContext.get().partitionId()
        held = None  # (id scalar, text, signature)
        for batch in batches:
            ids, rows, kinds, texts = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text").to_pylist()):
                signature = own.signature(text)
                if held is None:
                    ids.append(doc_id)
                    rows.append((None,) * 6)
                    kinds.append("first")
                    texts.append(text)
                else:
                    ids.append(held[0])
                    rows.append(_compare(own, *held[1:], text, signature))
                    kinds.append("row")
                    texts.append(None)
                held = (doc_id, text, signature)
            yield record(ids, rows, kinds, texts, part, batch.schema.field("doc_id").type)
        if held is not None:
            yield record([held[0]], [(None,) * 6], ["last"], [held[1]], part, held[0].type)

    def record(ids, rows, kinds, texts, part, kind):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array([i.as_py() for i in ids], kind), *(pa.array(c, t) for c, t in zip(cols, arrow)),
             pa.array(kinds, pa.string()), pa.array(texts, pa.string()),
             pa.array([part] * len(ids), pa.int32())],
            names=[*RESULT, "kind", "text", "part"])

    def close(batches):
        for batch in batches:
            rows = []
            for text, following in zip(batch.column("text").to_pylist(), batch.column("following").to_pylist()):
                rows.append(_compare(own, text, own.signature(text), following, own.signature(following)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows), arrow))], names=RESULT)

    ordered = (id_and_text(df, id_col, text_col).withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
               .select("doc_id", "text"))
    walked = stored(ordered.mapInArrow(walk, f"{fields}, kind string, text string, part int"), "ordered")
    # two rows of each partition that has any: as many as there are partitions
    first = walked.where("kind = 'first'").select(F.col("part").alias("at"), F.col("text").alias("following"))
    turns = first.select(
        F.col("at").alias("part"),
        F.coalesce(F.lead("at").over(Window.orderBy("at")),
                   F.min("at").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding,
                                                                     Window.unboundedFollowing))).alias("at"))
    ends = (walked.where("kind = 'last'").select("doc_id", "text", "part")
            .join(turns, "part").join(first, "at").select("doc_id", "text", "following"))
    return walked.where("kind = 'row'").select(*RESULT).union(ends.mapInArrow(close, fields))
