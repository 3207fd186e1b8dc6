"""Token ids as wavelet matrices, one compressed file per shard.

Documents are encoded in ascending doc_id order and cut into shards. A shard file keeps the bits of its token ids in planes,
highest bit first; before each further plane the tokens are parted by the bit just written, zeros first. With counts of ones
kept every 4,096 bits, a plane gives rank and select, and from these follow the token at a place, how often an id occurs
before a place, and where its n-th occurrence is, without decoding the rest.

Layout of a file, little endian: magic ``WMX1``, then 64-bit numbers: tokens, planes, documents, bytes of the document table,
bytes of each plane. After these the parts, each zstd-compressed on its own: the document table (doc_id, whether it is null,
tokens, as int64 columns) and the planes, eight bits to a byte, first bit lowest.
"""

from __future__ import annotations

import json
import re
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.shared import model_path, ship, shuffle_partitions, small_side, stored

MODEL = "word_bpe_49k.json"
END_ID = 2
SHARD_TOKENS = 1_000_000
MAGIC = b"WMX1"
BLOCK = 4096
#: Just below the entries from which on a dictionary's table doubles.
CACHED_CHUNKS = 690_000
CACHED_LENGTH = 64

SHARD_SCHEMA = "part int, number int, first_doc long, n_docs long, n_tokens long, file binary"


class WaveletMatrix:
    """Access, counting and occurrence lookup over a sequence of non-negative integers."""

    def __init__(self, length: int, planes: list[np.ndarray]):
        self.length, self.planes = length, planes
        self.zeros = [length - int(np.count_nonzero(bits)) for bits in planes]

    @cached_property
    def ones_before(self) -> list[np.ndarray]:
        """Of each plane, its ones before every block; only lookups need them."""
        out = []
        for bits in self.planes:
            padded = np.zeros(-(-max(1, self.length) // BLOCK) * BLOCK, dtype=np.uint8)
            padded[: self.length] = bits
            sums = padded.reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
            out.append(np.concatenate(([0], np.cumsum(sums))))
        return out

    @classmethod
    def of(cls, values: np.ndarray) -> WaveletMatrix:
        planes, now = [], np.asarray(values)
        if int(now.max(initial=0)) < 1 << 16:
            now = now.astype(np.uint16)
        for shift in reversed(range(max(1, int(now.max(initial=0)).bit_length()))):
            bits = ((now >> shift) & 1).astype(np.uint8)
            planes.append(bits)
            up = bits.view(bool)
            now = np.concatenate([now.take(np.flatnonzero(~up)), now.take(np.flatnonzero(up))])
        return cls(len(now), planes)

    def rank(self, plane: int, place: int) -> int:
        """Ones of a plane before a place."""
        block = place // BLOCK
        return int(self.ones_before[plane][block]) + int(np.count_nonzero(self.planes[plane][block * BLOCK : place]))

    def select(self, plane: int, bit: int, number: int) -> int:
        """The place of the number-th (from 0) such bit of a plane."""
        ones = self.ones_before[plane]
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(before, number, side="right")) - 1
        inside = np.flatnonzero(self.planes[plane][block * BLOCK : (block + 1) * BLOCK] == bit)
        return block * BLOCK + int(inside[number - int(before[block])])

    def access(self, place: int) -> int:
        value = 0
        for plane in range(len(self.planes)):
            bit = int(self.planes[plane][place])
            ones = self.rank(plane, place)
            place = self.zeros[plane] + ones if bit else place - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the last plane keeps the occurrences of a value among the first ``end`` places."""
        if value >> len(self.planes):
            return 0, 0
        begin = 0
        for plane in range(len(self.planes)):
            low, high = self.rank(plane, begin), self.rank(plane, end)
            if value >> (len(self.planes) - 1 - plane) & 1:
                begin, end = self.zeros[plane] + low, self.zeros[plane] + high
            else:
                begin, end = begin - low, end - high
        return begin, end

    def count(self, value: int, end: int | None = None) -> int:
        begin, stop = self._range(value, self.length if end is None else end)
        return stop - begin

    def locate(self, value: int, number: int) -> int | None:
        """The place of the number-th occurrence (from 0) of a value, or None."""
        begin, stop = self._range(value, self.length)
        if number >= stop - begin:
            return None
        place = begin + number
        for plane in reversed(range(len(self.planes))):
            bit = value >> (len(self.planes) - 1 - plane) & 1
            place = self.select(plane, bit, place - self.zeros[plane] if bit else place)
        return place

    def values(self) -> np.ndarray:
        """The whole sequence: from the last plane up, the parted halves are merged again."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.length, dtype=kind)
        for plane in reversed(range(len(self.planes))):
            up = self.planes[plane].view(bool)
            merged = np.empty_like(out)
            merged[np.flatnonzero(~up)] = out[: self.zeros[plane]]
            merged[np.flatnonzero(up)] = out[self.zeros[plane] :] | kind(1 << (len(self.planes) - 1 - plane))
            out = merged
        return out.astype(np.uint32)


def write_shard(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """A shard file."""
    matrix = WaveletMatrix.of(ids)
    pack = zstandard.ZstdCompressor(level=1).compress
    numbers = [[d or 0 for d in doc_ids], [int(d is None) for d in doc_ids], counts]
    table = pack(np.array(numbers, dtype="<i8").tobytes())
    planes = [pack(np.packbits(bits, bitorder="little").tobytes()) for bits in matrix.planes]
    head = struct.pack("<4q", matrix.length, len(planes), len(doc_ids), len(table))
    return b"".join([MAGIC, head, struct.pack(f"<{len(planes)}q", *map(len, planes)), table, *planes])


def read_shard(file: bytes) -> tuple[list[int | None], list[int], WaveletMatrix]:
    """doc_ids, tokens of each document, and the matrix of a shard file."""
    if file[:4] != MAGIC:
        raise ValueError("not a shard file")
    length, plane_count, documents, table_size = struct.unpack_from("<4q", file, 4)
    sizes = struct.unpack_from(f"<{plane_count}q", file, 36)
    at = 36 + 8 * plane_count
    unpack = zstandard.ZstdDecompressor().decompress
    table = np.frombuffer(unpack(file[at : at + table_size]), dtype="<i8").reshape(3, documents)
    at += table_size
    planes = []
    for size in sizes:
        raw = np.frombuffer(unpack(file[at : at + size]), dtype=np.uint8)
        planes.append(np.unpackbits(raw, count=length, bitorder="little"))
        at += size
    doc_ids = [None if missing else int(d) for d, missing in zip(table[0], table[1])]
    return doc_ids, table[2].tolist(), WaveletMatrix(length, planes)


class Remembered(dict):
    """Texts to the little-endian unsigned 32-bit ids that ``find`` gives for them.

    Short texts are remembered; all are forgotten when there are ``CACHED_CHUNKS`` of them.
    """

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find

    def __missing__(self, text: str) -> bytes:
        found = self.find(text)
        if len(text) <= CACHED_LENGTH:
            if len(self) >= CACHED_CHUNKS:
                self.clear()
            self[text] = found
        return found


class TextEncoder:
    """Encodes texts as the tokenizer does, chunk by chunk between blanks.

    The tokenizer drops white space and encodes what stands between it on its own, so the ids of a text are those of its
    chunks. A chunk of Latin letters, digits and signs is lower-cased, split and spelled in the model's byte alphabet here,
    which gives what the tokenizer's own steps give; any other chunk goes through those. A lower-case word is a chunk itself, of
    which chunks with capitals or a sign behind make use.
    """

    # Lower-casing changes no other letter's case than the tokenizer does, but for the dotted capital I.
    LATIN = re.compile("[!-~\u00a1-\u012f\u0131-\u024f]+")
    SIGNS = set("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")

    def __init__(self, model: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        path = model_path(model)
        self.tokenizer = Tokenizer.from_file(path)
        self.normal, self.split = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.tokens = self.tokenizer.model.tokenize
        # The tokenizer matches these strings before anything else.
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path) as file:
            steps = json.load(file)["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(steps[0]["pattern"]["Regex"]).findall
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {c: spell(chr(c))[0][0] for c in range(0xA1, 0x250)}
        self.pieces, self.chunks = Remembered(self._piece), Remembered(self._chunk)

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.translate(self.spelling)
        return array("I", [token.id for token in self.tokens(spelled)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        # Most chunks are a word, or a word and a sign.
        if chunk[-1:] in self.SIGNS:
            word, sign = chunk[:-1], self.pieces[chunk[-1]]
        else:
            word, sign = chunk, b""
        if word.isalpha() and (word.isascii() or self.LATIN.fullmatch(word)):
            lower = word.lower()
            # In a few cases the lower-case letter is none of the Latin ones here.
            return self._piece(chunk) if chunk == lower else self.chunks[lower] + sign
        if any(special in chunk for special in self.special):
            return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        if self.LATIN.fullmatch(chunk):
            return b"".join(map(self.pieces.__getitem__, self.words(chunk.lower())))
        return array("I", [t.id for piece, _ in self.split(self.normal(chunk)) for t in self.tokens(piece)]).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        try:
            text.encode("latin-1")
            # Such a text can be lower-cased as a whole, unless that makes a special token; fewer different chunks are left.
            lower = text.lower()
            if not any(special in lower for special in self.special):
                text = lower
        except UnicodeEncodeError:
            pass
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


_encoders: dict[str, TextEncoder] = {}


def encoder(model: str) -> TextEncoder:
    """The worker's encoder of a model, kept between tasks."""
    if model not in _encoders:
        _encoders[model] = TextEncoder(model)
    return _encoders[model]


def write_shards(
    documents: DataFrame, model: str = MODEL, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Shard files in ascending doc_id order, one row each with its file in ``file``, ordered by (part, number).

    Documents are dealt out by ranges of doc_id and sorted there (null first; rows with one doc_id by text, null first). A
    shard ends with the document that fills it, so a document lies in one shard. A null or empty text has the end id alone.
    """
    ship(documents.sparkSession)
    parts = shuffle_partitions(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.asc_nulls_first("text"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(model).encode
        part, number = TaskContext.get().partitionId(), 0
        doc_ids, counts, pieces, held = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                raw = encode(text.as_py() or "") + end
                doc_ids.append(doc_id.as_py())
                counts.append(len(raw) // 4)
                pieces.append(raw)
                held += len(raw) // 4
                if held >= shard_tokens:
                    yield shard(part, number, doc_ids, counts, pieces)
                    doc_ids, counts, pieces, held, number = [], [], [], 0, number + 1
        if doc_ids:
            yield shard(part, number, doc_ids, counts, pieces)

    def shard(part: int, number: int, doc_ids: list, counts: list, pieces: list) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(pieces), dtype="<u4")
        row = {"part": part, "number": number, "first_doc": doc_ids[0], "n_docs": len(doc_ids), "n_tokens": len(ids)}
        schema = pa.schema(
            [("part", pa.int32()), ("number", pa.int32()), *((n, pa.int64()) for n in ("first_doc", "n_docs", "n_tokens"))]
            + [("file", pa.binary())]
        )
        return pa.RecordBatch.from_pylist([row | {"file": write_shard(doc_ids, counts, ids)}], schema)

    return ordered.mapInArrow(run, SHARD_SCHEMA)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, number, start): tokens of all shards before; summed inside the parts and over the parts' totals."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    own = shards.select("part", "number", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inside"))
    return own.join(offsets, "part").select("part", "number", (F.col("inside") + F.col("before")).alias("start"))


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document of the shard files: doc_id, start, n_tokens and the CRC-32 of its ids."""
    ship(shards.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for file, start in zip(batch.column(0), batch.column(1)):
                doc_ids, counts, matrix = read_shard(file.as_py())
                raw = memoryview(matrix.values().astype("<u4").tobytes())
                ends = np.cumsum(counts)
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts)]
                columns = [doc_ids, (ends - counts + start.as_py()).tolist(), counts, sums]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    starts = small_side(stored(shard_starts(shards), "shard-starts"))
    files = shards.select("part", "number", "file").join(starts, ["part", "number"])
    return files.select("file", "start").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(documents: DataFrame, model: str = MODEL, end_id: int = END_ID) -> DataFrame:
    """Write the documents as shard files in the shared folder and report every document as read back from them."""
    return read_documents(stored(write_shards(documents, model, end_id), "token-shards"))
