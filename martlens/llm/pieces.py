"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it came from.

Normalisation walks over the text: at each place the longest prefix that the model's compiled character map holds is replaced,
any other character is kept. Every byte of the result remembers the place it came from, so the pieces, found on the normalised
text, project to spans of original bytes.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm.shared import model_path, ship, small_batches

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
BLOCK = 65_536
FLUSH_IDS = 2_000_000
CUT = re.compile(f"(?<!{SPACE}){SPACE}")


class CharacterMap:
    """The compiled map of a model: a double-array trie over UTF-8 bytes whose leaves point at replacement strings."""

    def __init__(self, compiled: bytes):
        self.units, self.replacements = np.empty(0, dtype=np.uint32), b""
        if compiled:
            (size,) = struct.unpack_from("<I", compiled)
            self.units = np.frombuffer(compiled[4 : 4 + size], dtype="<u4")
            self.replacements = compiled[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """The longest key that starts here: its length and its replacement."""
        if not len(self.units):
            return None
        best, place = None, 0
        unit = int(self.units[0])
        place ^= self._offset(unit)
        for i in range(at, len(text)):
            place ^= text[i]
            unit = int(self.units[place])
            if unit & 0x800000FF != text[i]:
                break
            place ^= self._offset(unit)
            if unit >> 8 & 1:
                best = (i + 1 - at, int(self.units[place]) & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.replacements[best[1] : self.replacements.index(b"\0", best[1])]

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)


@dataclass
class Normalizer:
    """Character map and white space rules of a model."""

    characters: CharacterMap
    dummy_prefix: bool
    drop_extra_spaces: bool
    escape: bool

    @property
    def plain(self) -> bool:
        """Nothing but blanks changes."""
        return not len(self.characters.units) and not self.drop_extra_spaces and self.escape and self.dummy_prefix

    def _units(self, text: bytes) -> Iterator[tuple[int, int, bytes, bool]]:
        """Place, length, what stands for it, and whether that is the text itself."""
        at = 0
        while at < len(text):
            hit = self.characters.longest(text, at)
            if hit:
                length, value = hit
            else:
                lead = text[at]
                length = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                value = text[at : at + length]
            yield at, length, value, not hit
            at += length

    def normalize(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them and for the end the byte of the original it came from.

        All bytes of a replacement came from where it starts; a character kept as it is keeps the places of its bytes.
        """
        space = SPACE.encode() if self.escape else b" "
        out, origin = bytearray(), []
        units = list(self._units(text.encode()))
        if self.drop_extra_spaces:
            while units and units[0][2] == b" ":
                units.pop(0)
        if not units:
            return b"", np.array([0], dtype=np.int64)
        if self.dummy_prefix:
            out.extend(space)
            origin.extend([units[0][0]] * len(space))
        blank_before = self.drop_extra_spaces
        for at, _, value, kept in units:
            if blank_before:
                value = value.lstrip(b" ")
            shown = value.replace(b" ", space)
            out.extend(shown)
            origin.extend(range(at, at + len(shown)) if kept and shown == value else [at] * len(shown))
            if value:
                blank_before = self.drop_extra_spaces and value.endswith(b" ")
        end = units[-1][0] + units[-1][1]
        if self.drop_extra_spaces:
            while out.endswith(space):
                end = origin[len(out) - len(space)]
                del out[-len(space) :], origin[-len(space) :]
        return bytes(out), np.array([*origin, end], dtype=np.int64)


@dataclass
class Encoded:
    """Ids with the end id last, and the begin and end byte of each in the original text; the end id is empty, at the end."""

    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


class Encoder:
    """Encodes texts with a model, block by block.

    If no piece of the model holds a blank after another character, a text may be cut before any run of blanks, so what the
    library holds at once is bounded. Blocks go to it one by one: given a list it starts threads, which cost more than they save.
    """

    def __init__(self, model: str = MODEL):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        path = model_path(model)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec = proto.normalizer_spec
        self.normalizer = Normalizer(
            CharacterMap(spec.precompiled_charsmap),
            spec.add_dummy_prefix,
            spec.remove_extra_whitespaces,
            spec.escape_whitespaces,
        )
        if not self.normalizer.escape or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that keep blanks as they are, or put them behind words, are not supported")
        # The pieces are found on normalised text, so this copy of the model must not normalise again.
        spec.ClearField("precompiled_charsmap")
        spec.name, spec.add_dummy_prefix, spec.remove_extra_whitespaces = "identity", False, False
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end_id = self.library.eos_id()
        self.unknown = self.pieces.unk_id()
        # A merge can cross a blank only if some piece holds one after another character.
        self.cuttable = not any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces if p.type == p.NORMAL)
        # Bytes of each piece where a blank counts as one; a piece for a byte is one.
        self.sizes = np.array(
            [1 if p.type == p.BYTE else len(p.piece.replace(SPACE, " ").encode()) for p in proto.pieces], dtype=np.int64
        )
        self.decimals = [str(i) for i in range(len(proto.pieces))]

    def _blocks(self, normal: str) -> Iterator[str]:
        """A normalised text, cut before the first run of blanks that follows ``BLOCK`` characters or more."""
        at = 0
        while self.cuttable and (cut := CUT.search(normal, at + BLOCK)):
            yield normal[at : cut.start()]
            at = cut.start()
        if normal:
            yield normal[at:]

    def _ids(self, normal: str) -> tuple[np.ndarray, str]:
        """The ids of a normalised text, also as decimal numbers joined by blanks."""
        found, shown = [np.empty(0, dtype=np.int64)], []
        for block in self._blocks(normal):
            found.append(self.pieces.encode(block, return_type="numpy"))
            shown.append(" ".join(map(self.decimals.__getitem__, found[-1].tolist())))
        return np.concatenate(found), " ".join(shown)

    def encode(self, text: str) -> tuple[Encoded, str]:
        """The pieces of a text, and its ids as decimal numbers joined by blanks."""
        plain = self.normalizer.plain and SPACE not in text
        if plain:
            normal, places = (SPACE + text.replace(" ", SPACE) if text else ""), None
        else:
            raw, places = self.normalizer.normalize(text)
            normal = raw.decode()
        ids, joined = self._ids(normal)
        lengths = self.sizes[ids]
        if (ids == self.unknown).any():
            found = self.pieces.encode(normal, return_type="proto").pieces
            lengths = np.array([len(p.surface.replace(SPACE, " ").encode()) for p in found], dtype=np.int64)
        ends = np.cumsum(lengths)
        if plain:
            # The first blank stands for no byte of the text.
            ends = np.maximum(ends - 1, 0)
            begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            last = int(ends[-1]) if len(ends) else 0
        else:
            # Counted with blanks as one byte; in the normalised text they have three.
            bytes_ = np.frombuffer(raw, dtype=np.uint8)
            starts = np.concatenate((np.flatnonzero(~blank_tails(bytes_)), [len(bytes_)]))
            ends = starts[ends]
            begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
            begins, ends, last = places[begins], places[ends], int(places[-1])
        joined = f"{joined} {self.end_id}" if joined else str(self.end_id)
        return Encoded(np.append(ids, self.end_id), np.append(begins, last), np.append(ends, last)), joined

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def blank_tails(normal: np.ndarray) -> np.ndarray:
    """Which bytes are the second or third of a blank of the normalised text."""
    tails = np.zeros(len(normal), dtype=bool)
    first, second, third = SPACE.encode()
    heads = np.flatnonzero((normal[:-2] == first) & (normal[1:-1] == second) & (normal[2:] == third))
    tails[heads + 1] = tails[heads + 2] = True
    return tails


_encoders: dict[str, Encoder] = {}


def encoder(model: str = MODEL) -> Encoder:
    """The worker's encoder of a model, kept between tasks."""
    if model not in _encoders:
        _encoders[model] = Encoder(model)
    return _encoders[model]


def encode(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids, and the begin and end byte of each id in the UTF-8 text. A null text is empty and has the end id alone."""
    ship(documents.sparkSession)
    small_batches(documents.sparkSession)
    schema = "doc_id long, ids array<int>, begins array<long>, ends array<long>"
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def rows(doc_id: int | None, text: str) -> tuple[tuple, int]:
        found, _ = encoder(model).encode(text)
        return (doc_id, found.ids, found.begins, found.ends), len(found.ids)

    return _mapped(documents, rows, schema, kinds)


def encode_digests(documents: DataFrame, model: str = MODEL, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the text decoded from them, and the CRC-32 of the pieces' spans.

    The spans are digested as begin and end of each id in turn, as little-endian signed 64-bit integers. ``with_ids`` adds the
    ids themselves.
    """
    ship(documents.sparkSession)
    small_batches(documents.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if with_ids:
        schema, kinds = schema + ", ids array<int>", [*kinds, pa.list_(pa.int32())]

    def rows(doc_id: int | None, text: str) -> tuple[tuple, int]:
        import zlib

        own = encoder(model)
        found, joined = own.encode(text)
        decoded = own.decode(found.ids.tolist())
        spans = np.stack([found.begins, found.ends], axis=1).astype("<i8")
        digests = (hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        row = (doc_id, len(found.ids), *digests, zlib.crc32(spans.tobytes()))
        return (row + (found.ids,) if with_ids else row), 200 + with_ids * len(found.ids)

    return _mapped(documents, rows, schema, kinds)


def _mapped(documents: DataFrame, rows, schema: str, kinds: list[pa.DataType]) -> DataFrame:
    names = [column.split()[0] for column in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [[] for _ in kinds], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                row, weight = rows(doc_id.as_py(), text.as_py() or "")
                for column, value in zip(out, row):
                    column.append(value)
                size += weight
                if size >= FLUSH_IDS:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)
                    out, size = [[] for _ in kinds], 0
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
