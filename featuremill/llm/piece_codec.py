"""SentencePiece encoding and decoding (operator 10) with a merge-type prefix table.

The model's text form writes each space as U+2581 and puts one such mark before the text.
Inside a chunk the unique last token of every prefix is stored (``prefix_merge``) and the
ids are recovered backwards. Chunks end before a mark that follows another character and
between a Latin letter and another character: no piece of the vocabulary holds such a pair
(checked when the model is loaded), so no token crosses that place. Characters outside the vocabulary become their
UTF-8 byte pieces and merge with nothing.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated
rows and tied or null ids each give their own row; an empty table gives an empty result;
further columns are ignored. Memory per task: one Arrow batch plus bounded memo tables.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from featuremill.llm.common import MEMO_LIMIT, file_bytes, id_and_text, map_batches, public_path
from featuremill.llm.prefix_merge import Memo, MergeTable

MARK = "▁"
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
CHUNK = re.compile(f"{MARK}*[{LETTERS}]+|{MARK}*[^{LETTERS}{MARK}]+|{MARK}+")


class PieceCodec:
    """Encoder and decoder of one BPE SentencePiece model (content of a .model file) with
    identity normalisation, a dummy prefix and byte fallback."""

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        model.ParseFromString(content)
        norm = model.normalizer_spec
        if (model.trainer_spec.model_type != pb.TrainerSpec.BPE or not model.trainer_spec.byte_fallback
                or norm.name != "identity" or not norm.add_dummy_prefix or norm.remove_extra_whitespaces):
            raise ValueError("not a BPE model with byte fallback, dummy prefix and identity normalisation")
        kind = pb.ModelProto.SentencePiece
        pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        score = {p.piece: -p.score for p in model.pieces if p.type == kind.NORMAL}
        if any(len(CHUNK.findall(p)) > 1 for p in pieces):
            raise ValueError("a piece spans what is cut into chunks")
        self.merge = MergeTable(pieces, lambda a, b: score.get(a + b))
        self.known = {p for p in pieces if len(p) == 1}
        own = "".join(map(re.escape, sorted(self.known)))
        self._runs = re.compile(f"[{own}]+|[^{own}]+")
        self.byte_id = [0] * 256
        self.surface: list[bytes] = []
        self.marked = [p.piece.startswith(MARK) for p in model.pieces]
        self.is_byte: list[bool] = []
        for i, p in enumerate(model.pieces):
            raw = p.piece.replace(MARK, " ").encode()
            if p.type == kind.BYTE:
                raw = bytes([int(p.piece[3:5], 16)])
                self.byte_id[raw[0]] = i
            elif p.type == kind.CONTROL:
                raw = b""
            elif p.type == kind.UNKNOWN:
                raw = model.trainer_spec.unk_surface.encode()
            self.surface.append(raw)
            self.is_byte.append(p.type == kind.BYTE)
        self._chunks = Memo(MEMO_LIMIT)

    def _word(self, word: str) -> bytes:
        return array("i", self.merge.backward(self.merge.table(word)[0])).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if self.known.issuperset(chunk):
            return self._word(chunk)
        out = []
        for run in self._runs.findall(chunk):
            out.append(self._word(run) if run[0] in self.known else
                       array("i", [self.byte_id[b] for b in run.encode()]).tobytes())
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        new, out = self._chunks.new, []
        for chunk in CHUNK.findall(MARK + text.replace(" ", MARK)):
            ids = new.get(chunk)
            if ids is None:
                ids = self._chunks.missed(chunk, self._chunk) if len(chunk) <= 64 else self._chunk(chunk)
            out.append(ids)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``: one leading space is the dummy prefix and goes; byte pieces
        that are not valid UTF-8 become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return ""
        raw = b"".join(map(self.surface.__getitem__, ids.tolist()))
        skip = self._leads_with_mark(ids)
        try:
            return raw[skip:].decode()
        except UnicodeDecodeError:
            return self._decode_broken(ids, skip)

    def _leads_with_mark(self, ids: np.ndarray) -> int:
        """1 if the first piece that has a surface starts with a mark, else 0."""
        for i in ids.tolist():
            if self.surface[i]:
                return int(self.marked[i])
        return 0

    def _decode_broken(self, ids: np.ndarray, skip: int) -> str:
        """Each byte of an invalid run of byte pieces becomes one U+FFFD."""
        out, run = [], b""
        for i in ids.tolist():
            if self.is_byte[i]:
                run += self.surface[i]
                continue
            out.append(_bytes_to_text(run))
            run = b""
            piece = self.surface[i]
            if skip and piece:
                piece, skip = piece[1:], 0
            out.append(piece.decode())
        out.append(_bytes_to_text(run))
        return "".join(out)


def _bytes_to_text(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_CODECS: dict[int, PieceCodec] = {}


def codec(content: bytes) -> PieceCodec:
    key = hash(content)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = PieceCodec(content)
    return _CODECS[key]


def _model(df: DataFrame, path: str | None):
    return df.sparkSession.sparkContext.broadcast(file_bytes(path or public_path("piece_bpe_32k.model")))


def encode_documents(df: DataFrame, model: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id and ids (array<int>)."""
    content = _model(df, model)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(content.value)
        ids = [own.encode(t) for t in batch.column("text").to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        values = pa.array(np.concatenate(ids), pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), values)],
            names=["doc_id", "ids"])

    id_type = df.schema[id_col].dataType.simpleString()
    return map_batches(id_and_text(df, id_col, text_col), encode, f"doc_id {id_type}, ids array<int>")


def decode_documents(df: DataFrame, model: str | None = None, id_col: str = "doc_id",
                     ids_col: str = "ids") -> DataFrame:
    """Per row of ``df``: doc_id, the ids and their text (null ids: no ids)."""
    from pyspark.sql import functions as F
    content = _model(df, model)

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(content.value)
        column = batch.column("ids")
        values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        texts = [own.decode(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), column, pa.array(texts, pa.string())],
                                          names=["doc_id", "ids", "text"])

    id_type = df.schema[id_col].dataType.simpleString()
    own = df.select(F.col(id_col).alias("doc_id"),
                    F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return map_batches(own, decode, f"doc_id {id_type}, ids array<int>, text string")
