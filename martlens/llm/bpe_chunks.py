"""Byte-level BPE encoding that reuses content-defined chunks.

A text is cut where a rolling hash of the 16 code points before a place is 0 in its lowest bits, so a passage that many documents
hold is cut alike in all of them. Chunks that several documents share are counted over the whole corpus; those whose reuse
saves most are encoded once, by one task each, and sent to all tasks. Any other chunk is encoded by the task that meets it and
remembered, in bounded memory, for later texts and tasks of the same worker, and so are the units between two blanks.

Tokens of a chunk need not be tokens of the text: a cut may go through a word, a run of blanks or a contraction. So joins are
encoded again. No merge and no word of the tokenizer goes across a blank that something other than white space follows, and that is
told by these two characters alone, so both the chunk and the text have a border there. Where the last border of what was accepted
and the first border inside the next chunk are found, everything between them is encoded anew, and both sides agree with the whole
text from there on; a chunk without a border inside is taken into the join, which then goes on into the next one. The ids are those
of the whole text, whatever the cuts.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm.shared import code_points, model_path, ship

MODEL = "byte_bpe_50k.json"
WINDOW = 16
#: A chunk ends at one of 512 places by its hash, has 64 code points at least and is cut after 4,096 at the latest.
AVERAGE_BITS = 9
LEAST, MOST = 64, 4096
#: The most chunks that are encoded once for all tasks. What is sent is at most so many chunks of at most ``MOST`` code points.
SENT_CHUNKS = 8192
#: The most units and chunks that a worker remembers, and the longest remembered unit. Of the units the older half goes at a time,
#: less those that were met again, so that frequent ones stay.
CACHED_WORDS, CACHED_CHUNKS, CACHED_LENGTH = 1_000_000, 10_000, 64
FLUSH_ROWS, FLUSH_IDS = 2_000, 2_000_000
#: Units that the library is given at once.
UNITS_AT_ONCE = 8192


def cuts(codes: np.ndarray) -> list[int]:
    """Where the chunks of a text end: content-defined places, the last one the end of the text."""
    size = len(codes)
    hashes, width, base = codes.astype(np.uint64), 1, 0x5851F42D4C957F2D
    hashes += np.uint64(0x9E3779B97F4A7C15)
    found: np.ndarray = np.empty(0, dtype=np.int64)
    if size > LEAST:
        while width < WINDOW:
            joined = hashes[:-width] * np.uint64(base)
            joined += hashes[width:]
            hashes = joined
            base, width = base * base % 2**64, width * 2
        hashes *= np.uint64(0x9E3779B97F4A7C15)
        # The highest bits are 0.
        found = np.flatnonzero(hashes < np.uint64(1 << 64 - AVERAGE_BITS)) + WINDOW
    ends, last = [], 0
    for place in found.tolist():
        while place - last > MOST:
            last += MOST
            ends.append(last)
        if place - last >= LEAST and place < size:
            ends.append(place)
            last = place
    while size - last > MOST:
        last += MOST
        ends.append(last)
    if size > last:
        ends.append(size)
    return ends


def chunk_key(chunk: str) -> int:
    import xxhash

    key = xxhash.xxh3_64_intdigest(chunk)
    return key - (key >> 63 << 64)


class Encoder:
    """Encodes texts with a tokenizer of byte-level BPE; ``sent`` holds chunks that were encoded before."""

    def __init__(self, model: str = MODEL, sent: dict[str, tuple] | None = None):
        # Batches are small, and tasks run side by side already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(model_path(model))
        self.library.no_truncation()
        self.library.no_padding()
        if self.library.normalizer is not None or type(self.library.pre_tokenizer).__name__ != "ByteLevel":
            raise ValueError("only byte-level tokenizers without a normalizer are supported")
        if self.library.pre_tokenizer.add_prefix_space or not self.library.pre_tokenizer.use_regex:
            raise ValueError("only tokenizers that split words with their blank before them are supported")
        added = self.library.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take blanks with them are not supported")
        self.added = {t.content: i for i, t in added.items()}
        self.specials = special_pattern(self.added)
        self.borders = regex.compile(r" (?=\S)")
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 2**16 else "<u4")
        self.bytes_of = [token_bytes(self.library.id_to_token(i), self.added) for i in range(size)]
        self.lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.digits = [str(i) for i in range(size)]
        self.sent = sent or {}
        # Units that were met since the older half of what was remembered went, and those from before.
        self.ids_of: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.long: list[str] = []
        self.heads: dict[str, bytes] = {}
        self.chunks: dict[str, tuple] = {}

    def units(self, text: str) -> list[str]:
        """A text, cut before every blank that something other than white space follows; those blanks are left out."""
        units = text.split(" ")
        heads = "".join([unit[:1] for unit in units[1:]])
        if len(heads) == len(units) - 1 and (not heads or heads.split() == [heads]):
            return units
        return self.borders.split(text)

    def packed(self, text: str) -> bytes:
        """The ids of a text by the library, as fixed-width numbers."""
        (found,) = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype=self.kind).tobytes()

    def learn(self, units: Iterable[str]) -> None:
        """Encode the units, each different and with a blank before it, that are not remembered yet."""
        known, older = self.ids_of, self.older
        new = [unit for unit in units if unit not in known]
        if older:
            known.update({unit: older[unit] for unit in new if unit in older})
            new = [unit for unit in new if unit not in known]
        self.long = [unit for unit in new if len(unit) > CACHED_LENGTH]
        for begin in range(0, len(new), UNITS_AT_ONCE):
            some = new[begin : begin + UNITS_AT_ONCE]
            # Units are independent, so they are encoded as one text; the bytes of the ids tell where each ends.
            ids = np.frombuffer(self.packed(" " + " ".join(some)), dtype=self.kind)
            ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(u.encode()) + 1 for u in some])) + 1
            raw, width = ids.tobytes(), self.kind.itemsize
            stops = (ends * width).tolist()
            known.update({u: raw[a:b] for u, a, b in zip(some, [0, *stops[:-1]], stops)})

    def forget(self) -> None:
        """Keep what is remembered within its bounds, when the units just learned have been used."""
        for unit in self.long:
            del self.ids_of[unit]
        if 2 * len(self.ids_of) > CACHED_WORDS:
            self.older, self.ids_of = self.ids_of, {}

    def unit_ids(self, units: list[str]) -> list[bytes]:
        """The packed ids of each of the units, with a blank before it; those not remembered yet are learned at once."""
        known = self.ids_of
        found = list(map(known.get, units))
        new = [place for place, ids in enumerate(found) if ids is None]
        if new:
            self.learn({units[place] for place in new})
            for place in new:
                found[place] = known[units[place]]
            self.forget()
        return found

    def inside(self, text: str) -> tuple[int, int, list[str]]:
        """Where the first and the last border inside a chunk are, and the units between them; both are -1 without a border."""
        units = self.units(text)
        if len(units) == 1:
            return -1, -1, []
        return len(units[0]), len(text) - len(units[-1]) - 1, units[1:-1]

    def chunk(self, text: str) -> tuple[int, int, bytes]:
        """``inside`` of a chunk, with the ids of its units."""
        first, last, units = self.inside(text)
        return first, last, b"".join(self.unit_ids(units))

    def encode(self, text: str) -> tuple[list[int], int, int]:
        """The ids of a text, the number of its chunks, and of those cuts that are no border, where chunks alone go wrong."""
        ids, chunks, crossed = [], 0, 0
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.added:
                ids.append(np.array([self.added[part]], dtype=self.kind).tobytes())
            elif part:
                number, through = self._segment(part, ids)
                chunks, crossed = chunks + number, crossed + through
        return np.frombuffer(b"".join(ids), dtype=self.kind).tolist(), chunks, crossed

    def _segment(self, text: str, ids: list[bytes]) -> tuple[int, int]:
        """Add the ids of a text without special tokens; the library is asked once for all its units that are new."""
        ends = cuts(code_points(text))
        # All units of the text that are asked for, and in text order: ids, or where units begin and end among them.
        units: list[str] = []
        pieces: list[bytes | tuple[int, int]] = []
        fresh: dict[str, tuple[int, int, tuple[int, int]]] = {}

        def asked(some: list[str]) -> tuple[int, int]:
            begin = len(units)
            units.extend(some)
            return begin, len(units)

        def again(join: str) -> None:
            """Add a join; it starts with the blank of a border, unless it starts the text."""
            head, *others = self.units(join)
            if head:
                pieces.append(self._head(head))
            pieces.append(asked(others))

        # Everything before ``at``, a border of the text or its start, is in ``pieces``.
        start = at = crossed = 0
        for end in ends:
            part = text[start:end]
            known = self.sent.get(part) or self.chunks.get(part) or fresh.get(part)
            first, last, inner = known or self.inside(part)
            crossed += start > 0 and first != 0
            if first >= 0:
                again(text[at : start + first])
                inner = inner if known else asked(inner)
                pieces.append(inner)
                at = start + last
            if known is None:
                fresh[part] = first, last, inner if first >= 0 else (0, 0)
            start = end
        again(text[at:])
        packed = self.unit_ids(units)
        for piece in pieces:
            ids.extend([piece] if isinstance(piece, bytes) else packed[slice(*piece)])
        if len(self.chunks) + len(fresh) > CACHED_CHUNKS:
            self.chunks.clear()
        if len(fresh) <= CACHED_CHUNKS:
            self.chunks.update({part: (a, b, b"".join(packed[slice(*inner)])) for part, (a, b, inner) in fresh.items()})
        return len(ends), crossed

    def _head(self, unit: str) -> bytes:
        """The packed ids of a unit that starts a text, so without a blank before it."""
        found = self.heads.get(unit)
        if found is None:
            found = self.packed(unit)
            if len(self.heads) >= CACHED_CHUNKS:
                self.heads.clear()
            if len(unit) <= CACHED_LENGTH:
                self.heads[unit] = found
        return found

    def joined(self, ids: list[int]) -> str:
        return ",".join(map(self.digits.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of ids, as the library decodes them; bytes that are no UTF-8 are replaced."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def encoder(model: str, sent: dict[str, tuple] | None = None) -> Encoder:
    """The worker's encoder of a model, which remembers what it met in earlier tasks, with other chunks that were sent."""
    if model not in _encoders:
        _encoders[model] = Encoder(model)
    _encoders[model].sent = sent or {}
    return _encoders[model]


# Printable Latin-1 stands for itself in a token, the other bytes in order are the code points from 256.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PLAIN]


def token_bytes(token: str, added: dict[str, int]) -> bytes:
    """The bytes a token stands for."""
    if token in added:
        return token.encode()
    return bytes([_OTHERS[c - 256] if c >= 256 else c for c in map(ord, token)])


def texts_of(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[str]:
    for batch in batches:
        for value in batch.column(column):
            yield value.as_py() or ""


def special_pattern(names: Iterable[str]):
    """What splits a text at the special tokens, the longest first; None without any."""
    import regex

    longest = sorted(names, key=len, reverse=True)
    return regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None


@cache
def specials_of(model: str):
    """``special_pattern`` of a tokenizer's file, without its vocabulary being built up."""
    with open(model_path(model)) as file:
        return special_pattern([token["content"] for token in json.load(file)["added_tokens"]])


def segments(text: str, specials) -> list[str]:
    return [part for part in (specials.split(text) if specials else [text])[::2] if part]


def shared_chunks(documents: DataFrame, model: str = MODEL, most: int = SENT_CHUNKS) -> dict[str, tuple]:
    """What ``Encoder.chunk`` gives for the ``most`` chunks whose reuse saves most, encoded once each; for ``Encoder.sent``.

    Every chunk of every document is counted by a 64-bit key, once per document. Only keys with counts move; the texts of the chosen
    chunks follow in a second pass. A wrong choice by two chunks with one key costs time only.
    """
    spark = documents.sparkSession
    ship(spark)
    texts = documents.select("text")

    def chunks_of(text: str, specials) -> Iterator[str]:
        for segment in segments(text, specials):
            start = 0
            for end in cuts(code_points(segment)):
                yield segment[start:end]
                start = end

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials, held = specials_of(model), {}

        def flushed() -> pa.RecordBatch:
            keys = np.fromiter(held.keys(), dtype=np.int64, count=len(held))
            values = np.array(list(held.values()), dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(values[:, 0]), pa.array(values[:, 1])], ["key", "documents", "size"]
            )

        for text in texts_of(batches, 0):
            for chunk in set(chunks_of(text, specials)):
                key = chunk_key(chunk)
                held[key] = (held.get(key, (0, 0))[0] + 1, len(chunk))
            if len(held) > 500_000:
                yield flushed()
                held = {}
        if held:
            yield flushed()

    per_key = (
        texts.mapInArrow(counted, "key long, documents long, size long")
        .groupBy("key")
        .agg(F.sum("documents").alias("documents"), F.max("size").alias("size"))
    )
    saved = (F.col("documents") - 1) * F.col("size")
    chosen = per_key.where("documents > 1").orderBy(saved.desc(), "key").limit(most).collect()
    wanted = spark.sparkContext.broadcast({row["key"] for row in chosen})

    def met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials, seen = specials_of(model), set()
        for text in texts_of(batches, 0):
            found = [c for c in set(chunks_of(text, specials)) if c not in seen and chunk_key(c) in wanted.value]
            seen.update(found)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["chunk"])

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        names, kinds = ["chunk", "first", "last", "ids"], [pa.string(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            rows = [(chunk, *own.chunk(chunk)) for chunk in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    once = texts.mapInArrow(met, "chunk string").distinct() if chosen else spark.createDataFrame([], "chunk string")
    rows = once.mapInArrow(encoded, "chunk string, first int, last int, ids binary")
    return {row["chunk"]: (row["first"], row["last"], bytes(row["ids"])) for row in rows.toLocalIterator()}


def encode(documents: DataFrame, model: str = MODEL, most: int = SENT_CHUNKS) -> DataFrame:
    """doc_id and ids of every document; a null or empty text has none. Repeated rows are each encoded."""
    return _mapped(documents, model, most, "doc_id long, ids array<int>", [pa.int64(), pa.list_(pa.int32())], False)


def encode_digests(documents: DataFrame, model: str = MODEL, most: int = SENT_CHUNKS) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the text decoded from them, and how the text was cut.

    ``n_chunks`` counts the chunks of the text, ``n_crossed`` those joins of two chunks that lie inside a unit, where the tokens of
    the chunks taken alone may be wrong. A null or empty text has no ids; its digests are those of the empty string.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_chunks long, n_crossed long"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return _mapped(documents, model, most, schema, kinds, True)


def _mapped(documents: DataFrame, model: str, most: int, schema: str, kinds: list[pa.DataType], digests: bool) -> DataFrame:
    spark: SparkSession = documents.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(shared_chunks(documents, model, most))
    names = [column.split()[0] for column in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model, held.value)
        rows, size = [], 0

        def flushed() -> pa.RecordBatch:
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                ids, chunks, crossed = own.encode(value.as_py() or "")
                if digests:
                    joined = own.joined(ids)
                    decoded = own.decode(ids)
                    shas = [hashlib.sha256(text.encode()).hexdigest() for text in (joined, decoded)]
                    rows.append((doc_id.as_py(), len(ids), *shas, chunks, crossed))
                else:
                    rows.append((doc_id.as_py(), ids))
                    size += len(ids)
                if len(rows) >= FLUSH_ROWS or size >= FLUSH_IDS:
                    yield flushed()
                    rows.clear()
                    size = 0
        if rows:
            yield flushed()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
