"""SimHash near-duplicates (operator 9): fingerprints, pigeonhole blocks, verified links.

Fingerprints: the 3-word shingles of the ASCII-lower-cased text (repeats count; a text of
fewer words is one shingle, a text without words has fingerprint zero), XXH64 with seed 42
over UTF-8; a bit is set if more than half of the hashes have it.

Links: fingerprints at most ``bits`` (3) apart. The 64 bits are split into ``blocks`` (6);
two fingerprints that differ in 3 bits agree on at least 3 whole blocks, so they share one
of the 20 keys made of 3 blocks each (about 32 bits, which keeps chance meetings rare).
Equal fingerprints are one node from the start, so groups of copies of any size cost one
row. Within one key the members are compared by Hamming distance, and only a spanning set
of the verified links is emitted: no list of all pairs, no lost connection. A key with more
than ``LARGE`` members is not compared in one place: its members are keyed once more by 3 of 6
blocks of the remaining bits (two linked members again share one of 20 such keys), after
which at most 2^16 different fingerprints can meet.

Defined results: null texts count as empty (fingerprint zero, linked like any other); a null
id is no candidate for the smallest id of its component; repeated rows are members of their
component like others; an empty table gives an empty result; further columns are ignored (and kept
by ``keep_one_of_each``). Memory per task: one Arrow batch, the shingle hashes of its longest text
(8 bytes a word), or the members of one key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import by_place, id_and_text, map_batches, stored, whole_text
from featuremill.llm.components import connected_components

BITS = 3
BLOCKS = 6
#: Members of one key that are compared in one task without keying them again.
LARGE = 4096


def shingle_hashes(text: str, words: int = 3, seed: int = 42) -> np.ndarray:
    from xxhash import xxh64_intdigest
    own = text.encode().lower().split()  # bytes: A-Z only, and splits at space and \x09-\x0D
    if not own:
        return np.empty(0, np.uint64)
    if len(own) < words:
        return np.array([xxh64_intdigest(b" ".join(own), seed)], np.uint64)
    parts = map(b" ".join, zip(*(own[i:] for i in range(words))))
    return np.fromiter((xxh64_intdigest(p, seed) for p in parts), np.uint64, len(own) - words + 1)


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """The fingerprint as an unsigned 64-bit number."""
    hashes = shingle_hashes(text, words, seed)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text_hash (64 bits of the whole text) and fp (the fingerprint's bits as
    a signed long)."""
    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(fps.view(np.int64))],
            names=["doc_id", "text_hash", "fp"])

    id_type = df.schema[id_col].dataType.simpleString()
    own = id_and_text(df, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return map_batches(own, scan, f"doc_id {id_type}, text_hash long, fp long")


def _cuts(bits: list[int], blocks: int) -> list[list[int]]:
    """``bits`` split into ``blocks`` runs of nearly equal size."""
    edge = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    return [bits[a:b] for a, b in zip(edge, edge[1:])]


def block_masks(bits: list[int], blocks: int, distance: int) -> list[int]:
    """Masks of ``blocks - distance`` whole blocks each: fingerprints that differ in at most
    ``distance`` of ``bits`` agree under at least one."""
    cut = _cuts(bits, blocks)
    return [sum(1 << b for block in chosen for b in block)
            for chosen in combinations(cut, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(masks: list[int]) -> Column:
    """(mask number, masked fingerprint) for each mask."""
    return F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks)]))


def spanning_links(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints: each part reached from one
    member, by comparing the members reached so far with those not yet reached."""
    rest = fps.view(np.uint64)
    links = []
    while len(rest):
        wave, rest = rest[:1], rest[1:]
        while len(wave) and len(rest):
            head, wave = wave[0], wave[1:]
            near = np.bitwise_count(rest ^ head) <= distance
            if near.any():
                got = rest[near]
                links += [(int(head.view(np.int64)), int(x)) for x in got.view(np.int64)]
                wave = np.concatenate([wave, got])
                rest = rest[~near]
    return links


def verified_links(nodes: DataFrame, distance: int = BITS, blocks: int = BLOCKS, large: int = LARGE) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``nodes.fp`` whose connected components
    are those of all links within ``distance``."""
    masks = block_masks(list(range(64)), blocks, distance)
    keyed = nodes.select("fp", _keys(masks).alias("k")).select("fp", "k.mask", "k.key")
    sizes = (keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("members"))
             .where("members > 1"))
    met = keyed.join(sizes, ["mask", "key"])
    few = met.where(F.col("members") <= large).select("mask", "key", F.lit(-1).alias("mask2"),
                                                      F.lit(0).cast("long").alias("key2"), "fp")
    # the bits that a mask leaves open, cut once more
    inner = [block_masks([b for b in range(64) if not m >> b & 1], blocks, distance) for m in masks]
    again = F.element_at(F.array(*[
        F.array(*[F.struct(F.lit(j).alias("mask2"),
                           F.col("fp").bitwiseAND(F.lit(_signed(m2))).alias("key2"))
                  for j, m2 in enumerate(own)]) for own in inner]), F.col("mask") + 1)
    many = (met.where(F.col("members") > large).withColumn("k2", F.explode(again))
            .select("mask", "key", "k2.mask2", "k2.key2", "fp"))

    key = ["mask", "key", "mask2", "key2"]
    return (few.union(many).repartition(*key).sortWithinPartitions(*key, "fp")
            .mapInArrow(lambda batches: _links_of_groups(batches, key, distance), "a long, b long").distinct())


def _links_of_groups(batches, key: list[str], distance: int):
    """Links of each group of equal keys in a sorted stream; only the group that a batch ends
    with is held over to the next one."""
    held = None

    def links(rows: np.ndarray) -> pa.RecordBatch:
        fps = rows[-1]
        edge = np.flatnonzero(np.concatenate([[True], (rows[:-1, 1:] != rows[:-1, :-1]).any(axis=0), [True]]))
        size = np.diff(edge)
        two = edge[:-1][size == 2]
        near = np.bitwise_count(fps.view(np.uint64)[two] ^ fps.view(np.uint64)[two + 1]) <= distance
        found = [np.stack([fps[two[near]], fps[two[near] + 1]], axis=1)]
        for at, n in zip(edge[:-1][size > 2], size[size > 2]):
            found.append(np.array(spanning_links(np.unique(fps[at:at + n]), distance), np.int64).reshape(-1, 2))
        pairs = np.concatenate(found)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in [*key, "fp"]])
        if held is not None:
            rows = np.concatenate([held, rows], axis=1)
        if rows.shape[1]:
            last = np.flatnonzero((rows[:-1] != rows[:-1, -1:]).any(axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = rows[:, cut:]
            if cut:
                yield links(rows[:, :cut])
    if held is not None and held.shape[1]:
        yield links(held)


def near_duplicates(df: DataFrame, words: int = 3, distance: int = BITS, blocks: int = BLOCKS,
                    large: int = LARGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text_hash, fp, root and component_id, the smallest id that is reachable
    over links of at most ``distance`` differing bits. ``root``, the smallest fingerprint of the
    component, tells components apart also where their smallest ids are equal or null."""
    rows = stored(fingerprints(df, words, id_col, text_col), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "nodes")
    roots = connected_components(verified_links(nodes, distance, blocks, large))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select(
        F.col("fp").alias("node_fp"), F.coalesce("root", "fp").alias("root"), "lowest")
    lowest = named.groupBy("root").agg(F.min("lowest").alias("component_id"))
    member = stored(named.join(lowest, "root").select("node_fp", "root", "component_id"), "members")
    return (rows.join(member, rows.fp == member.node_fp)
            .select("doc_id", "text_hash", "fp", "root", "component_id"))


def keep_one_of_each(df: DataFrame, words: int = 3, distance: int = BITS) -> DataFrame:
    """``df`` with one row of each component: a row of its smallest id (of the smallest text
    hash among equal ids; a component of null ids keeps one of them)."""
    found = near_duplicates(df, words, distance)
    best = (found.groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("best"))
            .select(F.col("best.doc_id").alias("keep_id"), F.col("best.text_hash").alias("keep_hash")))
    own, name = by_place(df)
    hashed = own.withColumn("own_hash", F.xxhash64(whole_text(name["text"])))
    return (hashed.join(best, F.col(name["doc_id"]).eqNullSafe(F.col("keep_id"))
                        & (F.col("own_hash") == F.col("keep_hash")))
            .dropDuplicates([name["doc_id"], "own_hash"]).select(*own.columns).toDF(*df.columns))
