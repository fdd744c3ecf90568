"""Offset-preserving SentencePiece encoding and decoding.

Normalisation is done here, not by the library: at each position the longest prefix in the model's compiled
character map is replaced, white space is escaped, and every normalised byte records the original byte it came from.
The library then only segments: it runs on the normalised text with its own normaliser switched off. Every piece is
projected through the record to a span of original bytes. Texts are cut, before segmentation, between characters
that stand side by side in no piece: no merge can cross such a cut, so the parts can be segmented once and remembered.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import pick, row_chunks, tidy
from .word_tokens import Memory

SPACE = "▁"
_BAD = "�".encode()


class CharsMap:
    """The compiled character map of a model: a double-array trie over UTF-8 bytes and the replacements it points to."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self._units = np.frombuffer(blob, dtype="<u4", offset=4, count=size // 4).tolist() if blob else []
        self._texts = blob[4 + size :] if blob else b""
        #: Bytes with which some key begins.
        self.heads = {b for b in range(256) if self._units and self._step(self._units[0], 0, b) is not None}

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _step(self, unit: int, at: int, byte: int) -> tuple[int, int] | None:
        """From the node of ``unit`` at place ``at`` by one byte: (unit, place) there, or None."""
        place = at ^ self._offset(unit) ^ byte
        if place >= len(self._units) or self._units[place] & 0x800000FF != byte:
            return None
        return self._units[place], place

    def longest(self, data: bytes, start: int) -> tuple[bytes, int] | None:
        """(replacement, length) of the longest key that ``data`` has at ``start``."""
        if not self._units or data[start] not in self.heads:
            return None
        found = None
        unit, at = self._units[0], 0
        for i in range(start, len(data)):
            step = self._step(unit, at, data[i])
            if step is None:
                break
            unit, at = step
            if unit >> 8 & 1:
                value = self._units[at ^ self._offset(unit)] & 0x7FFFFFFF
                found = (self._texts[value : self._texts.index(b"\0", value)], i + 1 - start)
        return found


def _char(data: bytes, at: int) -> tuple[bytes, int]:
    """One UTF-8 character; a malformed byte reads as U+FFFD."""
    first = data[at]
    n = 1 if first < 0x80 else 2 if 0xC2 <= first < 0xE0 else 3 if 0xE0 <= first < 0xF0 else 4 if 0xF0 <= first < 0xF5 else 0
    piece = data[at : at + n]
    try:
        piece.decode()
    except UnicodeDecodeError:
        n = 0
    return (piece, n) if n else (_BAD, 1)


class Normaliser:
    """Normalised bytes and, for each of them and the end, the original byte."""

    def __init__(self, spec) -> None:
        self.map = CharsMap(spec.precompiled_charsmap)
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self._space = SPACE.encode() if self.escape else b" "
        self.plain = not self.map.heads and not self.trim

    def __call__(self, data: bytes, suffix: bool = False) -> tuple[bytes, np.ndarray]:
        """``suffix``: the added blank goes to the end, as for models that treat blanks as suffixes."""
        if self.plain and not suffix:
            return self._plain(data)
        return self._mapped(data, suffix)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        if not data:
            return b"", np.zeros(1, np.int64)
        raw = np.frombuffer(data, dtype=np.uint8)
        at = np.repeat(np.arange(len(raw)), np.where(raw == 32, len(self._space), 1))
        head = self._space if self.prefix else b""
        return head + data.replace(b" ", self._space), np.concatenate([np.zeros(len(head), np.int64), at, [len(raw)]])

    def _next(self, data: bytes, at: int) -> tuple[bytes, int]:
        return self.map.longest(data, at) or _char(data, at)

    def _mapped(self, data: bytes, suffix: bool) -> tuple[bytes, np.ndarray]:
        at, out, where = 0, bytearray(), []
        if self.trim:
            while at < len(data) and (step := self._next(data, at))[0] == b" ":
                at += step[1]
        if at == len(data):
            return b"", np.zeros(1, np.int64)

        def put(piece: bytes) -> None:
            out.extend(piece)
            where.extend([at] * len(piece))

        if self.prefix and not suffix:
            put(self._space)
        blank = self.trim
        while at < len(data):
            piece, n = self._next(data, at)
            while blank and piece.startswith(b" "):
                piece = piece[1:]
            if piece:
                put(piece.replace(b" ", self._space))
                blank = piece.endswith(b" ")
            at += n
            blank = blank and self.trim
        if self.trim:
            while out.endswith(self._space):
                at = where[len(out) - len(self._space)]
                del out[-len(self._space) :], where[-len(self._space) :]
        if self.prefix and suffix:
            put(self._space)
        return bytes(out), np.array([*where, at], dtype=np.int64)


class Codec:
    """A SentencePiece model: whole texts to ids and spans, ids to texts."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normaliser = Normaliser(proto.normalizer_spec)
        self._suffix = proto.trainer_spec.treat_whitespace_as_suffix
        pieces = [p.piece for p in proto.pieces]
        kinds = [p.type for p in proto.pieces]
        spec = proto.normalizer_spec
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = b"", False, False, False
        self._bare = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        byte, user = 6, 4
        #: Normalised bytes of a piece.
        self._sizes = np.array([1 if k == byte else len(p.encode()) for p, k in zip(pieces, kinds, strict=True)], dtype=np.int64)
        self._unknown = self.processor.unk_id()
        self._exact_sizes = proto.trainer_spec.byte_fallback
        self.end_id = self.processor.eos_id()
        self._beside = {p[i : i + 2] for p, k in zip(pieces, kinds, strict=True) if k != byte for i in range(len(p) - 1)}
        # BPE without reserved strings; without byte fallback a run of unknown characters is one id, which cuts would divide
        self._parted = proto.trainer_spec.model_type == 2 and user not in kinds and proto.trainer_spec.byte_fallback
        self._spaced = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self._parts = Memory(self._segment)
        self._words = Memory(self._word)
        self._numbers = [str(i) for i in range(len(pieces))]

    def _segment(self, text: str) -> bytes:
        return np.array(self._bare.encode(text), dtype="<u4").tobytes() if text else b""

    def _word(self, text: str) -> bytes:
        """Ids of a text cut wherever two characters are beside each other in no piece."""
        out, start, beside = [], 0, self._beside
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in beside:
                out.append(self._parts[text[start:i]])
                start = i
        out.append(self._parts[text[start:]])
        return b"".join(out)

    def ids(self, normalised: str) -> np.ndarray:
        if not (self._parted and self._spaced):
            return np.array(self._bare.encode(normalised), dtype="<u4") if normalised else np.zeros(0, "<u4")
        look = self._words.__getitem__
        if SPACE + SPACE in normalised:
            found = map(look, re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", normalised))
        else:
            head, *rest = normalised.split(SPACE)
            found = [look(head) if head else b"", *map(look, [SPACE + w for w in rest])]
        return np.frombuffer(b"".join(found), dtype="<u4")

    def encode(self, text: str | None, spans: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """(ids with the end id, array of (start, end) in original bytes for each but the end id)."""
        data = (text or "").encode()
        normalised, where = self.normaliser(data, self._suffix)
        ids = self.ids(normalised.decode())
        full = np.append(ids, np.uint32(self.end_id))
        if not spans:
            return full, None
        sizes = self._sizes[ids]
        if not self._exact_sizes and (ids == self._unknown).any():
            # such models give one id to a run of unknown characters, whose piece is the run itself
            found = self._bare.encode(normalised.decode(), return_type="proto").pieces
            sizes = np.array([len(p.piece.encode()) for p in found], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return full, np.stack([where[ends[:-1]], where[ends[1:]]], axis=1)

    def decode(self, ids: np.ndarray) -> str:
        return self.processor.decode(ids.tolist())

    def digest(self, ids: np.ndarray) -> str:
        return hashlib.sha256(" ".join(map(self._numbers.__getitem__, ids.tolist())).encode()).hexdigest()


@functools.cache
def codec(path: str) -> Codec:
    """One memory for all tasks of a Python worker."""
    return Codec(path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, starts, ends): ids with an end id, and the original byte span of each piece.

    Null and empty texts have the end id alone. Rows are independent, repeated rows come out equal, null ids stay
    null, other columns are ignored.
    """

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            for lo, hi in row_chunks(batch.column(1)):
                found = [c.encode(t) for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                starts, ends = ([s[:, k].astype(np.int64) for _, s in found] for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), _lists([i.astype(np.int32) for i, _ in found], pa.int32()),
                        _lists(starts, pa.int64()), _lists(ends, pa.int64())
                    ],
                    ["doc_id", "ids", "starts", "ends"],
                )

    return pick(docs, "doc_id", "text").mapInArrow(tidy(act), "doc_id long, ids array<int>, starts array<long>, ends array<long>")


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.array(np.concatenate(rows), kind))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of ``encoded(doc_id, ids)``; null ids read as none."""

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            texts = [c.processor.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return pick(encoded, "doc_id", "ids").mapInArrow(tidy(act), "doc_id long, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32): digests of what ``encode`` and ``decode`` give.

    spans_crc32 is of the (start, end) pairs of all pieces, as little-endian 64-bit numbers. Ids never leave the task.
    """

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            rows = []
            for lo, hi in row_chunks(batch.column(1)):
                for text in batch.column(1).slice(lo, hi - lo).to_pylist():
                    ids, spans = c.encode(text)
                    decoded = hashlib.sha256(c.decode(ids).encode()).hexdigest()
                    rows.append((len(ids), c.digest(ids), decoded, zlib.crc32(np.ascontiguousarray(spans, dtype="<i8"))))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"],
            )

    return pick(docs, "doc_id", "text").mapInArrow(
        tidy(act), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"
    )
