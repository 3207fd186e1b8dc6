"""Collocations: phrases of two to four words that hold together, by exact counts.

Words that occur often enough are ranked by frequency, so a pair of neighbours is a cell of a matrix whose counts gather in one
corner. The matrix is laid out in tiles of 1,024 by 1,024 ranks. In a task, a tile that is met often is an array counted by
``bincount`` at the cell's address; the cells of all others are kept as sorted coordinates with counts. The tasks' cells are then
added up by Spark. Pairs that are frequent enough are ranked in turn, and a pair with the word behind it is a cell of the next
matrix, and once more for four words: a phrase cannot be more frequent than what it contains.

The ranks that tasks are given are bounded in number. Frequent words and phrases beyond them are told by bitmaps of the hashes of
their cells, or of their texts where they have no cell. Bitmaps have a fixed size, and phrases with such a part are counted as text.
A hash met by chance costs a counted phrase, not an error.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.shared import ship, stored

LEAST_COUNT = 30
MOST_WORDS = 4
BEST = 2000
#: Ranks given to tasks for each number of words, over all languages, and the bytes of the longest word that gets one.
RANK_BITS = 18
RANKS = 2**RANK_BITS
RANKED_BYTES = 64
#: Side of a tile; a tile that takes so many of a buffer's cells is counted by address, for at most so many tiles.
TILE = 1024
DENSE_CELLS = TILE * TILE // 16
DENSE_TILES = 16
BUFFER, COORDINATES, TEXTS = 1_000_000, 1_500_000, 300_000
REST_BITS = 24
MASK_BITS = 22
BLOCK_BYTES = 2_000_000
LANG_SHIFT = 2 * RANK_BITS

# Only A-Z are lowered; these end a piece; blank and tab stand between words.
_END = 255
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else _END if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
_BREAK = bytes([_END])


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], int]]:
    """(language, words, carried): the words of a batch by language, with a mark where a piece ends.

    Texts come in blocks of bounded size. A block that goes on inside a piece starts with the words before it, as many as
    ``carried`` says.
    """
    of_lang: dict[str, list[bytes]] = {}
    for text, lang in zip(batch.column(0), batch.column(1)):
        if text.is_valid:
            of_lang.setdefault(lang.as_py(), []).append(text.as_buffer().to_pybytes())
    for lang, texts in of_lang.items():
        joined, size = [], 0
        for text in texts:
            if joined and size + len(text) > BLOCK_BYTES:
                yield from _pieces_of(lang, _BREAK.join(joined).translate(_TABLE))
                joined, size = [], 0
            joined.append(text)
            size += len(text)
        yield from _pieces_of(lang, _BREAK.join(joined).translate(_TABLE))


def _pieces_of(lang: str, text: bytes) -> Iterator[tuple[str, list[bytes], int]]:
    start, carried = 0, []
    while start < len(text):
        stop = start + BLOCK_BYTES
        if stop >= len(text):
            stop = len(text)
        else:
            cut = max(text.rfind(_BREAK, start, stop), text.rfind(b" ", start, stop))
            if cut < 0:
                found = [p for p in (text.find(_BREAK, stop), text.find(b" ", stop)) if p >= 0]
                cut = min(found) if found else len(text) - 1
            stop = cut + 1
        words = text[start:stop].replace(_BREAK, b" " + _BREAK + b" ").split()
        yield lang, carried + words, len(carried)
        carried = (carried + words)[1 - MOST_WORDS :]
        start = stop


# ---- counting in a task ------------------------------------------------------------------------------------------


class Tiles:
    """Counts of cells: by address in tiles that are met often, as sorted coordinates elsewhere."""

    def __init__(self):
        self.buffer: list[np.ndarray] = []
        self.buffered = 0
        self.dense: dict[int, np.ndarray] = {}
        self.cells = self.counts = np.empty(0, dtype=np.int64)

    def add(self, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.buffer.append(cells)
        self.buffered += len(cells)
        if self.buffered >= BUFFER:
            self._settle()
            if len(self.cells) >= COORDINATES:
                yield from self._rows(self.cells, self.counts)
                self.cells = self.counts = np.empty(0, dtype=np.int64)

    def rest(self) -> Iterator[pa.RecordBatch]:
        self._settle()
        yield from self._rows(self.cells, self.counts)
        for tile, counts in self.dense.items():
            at = np.flatnonzero(counts)
            yield from self._rows(self._cells(tile, at), counts[at].astype(np.int64))

    def _settle(self) -> None:
        if not self.buffer:
            return
        cells = np.concatenate(self.buffer)
        self.buffer, self.buffered = [], 0
        tiles = self._tiles(cells)
        found, sizes = np.unique(tiles, return_counts=True)
        for tile in found[sizes >= DENSE_CELLS].tolist():
            if len(self.dense) < DENSE_TILES:
                self.dense.setdefault(tile, np.zeros(TILE * TILE, dtype=np.int32))
        for tile, counts in self.dense.items():
            here = tiles == tile
            if here.any():
                counts += np.bincount(self._addresses(cells[here]), minlength=TILE * TILE).astype(np.int32)
                cells, tiles = cells[~here], tiles[~here]
        cells, counts = np.unique(cells, return_counts=True)
        both = np.concatenate([self.cells, cells])
        order = np.argsort(both, kind="stable")
        both, counts = both[order], np.concatenate([self.counts, counts])[order]
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.empty(0, dtype=np.int64)
        self.cells, self.counts = both[first], np.add.reduceat(counts, first) if len(first) else counts

    @staticmethod
    def _tiles(cells: np.ndarray) -> np.ndarray:
        side = TILE.bit_length() - 1
        column = (cells & (RANKS - 1)) >> side
        return (cells >> (RANK_BITS + side)) << (RANK_BITS - side) | column

    @staticmethod
    def _addresses(cells: np.ndarray) -> np.ndarray:
        return ((cells >> RANK_BITS) & (TILE - 1)) * TILE + (cells & (TILE - 1))

    @staticmethod
    def _cells(tile: int, at: np.ndarray) -> np.ndarray:
        side = TILE.bit_length() - 1
        row, column = tile >> (RANK_BITS - side), tile & ((1 << (RANK_BITS - side)) - 1)
        return (row * TILE + at // TILE) << RANK_BITS | (column * TILE + at % TILE)

    @staticmethod
    def _rows(cells: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(cells), 200_000):
            yield cell_rows(cells[i : i + 200_000], counts[i : i + 200_000])


_SCHEMA = "cell long, lang string, phrase string, n long"
_NAMES = ["cell", "lang", "phrase", "n"]


def cell_rows(cells: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    nothing = pa.nulls(len(cells), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(cells), nothing, nothing, pa.array(counts)], _NAMES)


def text_rows(held: Counter) -> pa.RecordBatch:
    langs, phrases = [lang for lang, _ in held], pa.array([phrase for _, phrase in held], pa.binary()).cast(pa.string())
    counts = pa.array(list(held.values()), pa.int64())
    return pa.RecordBatch.from_arrays([pa.nulls(len(held), pa.int64()), pa.array(langs, pa.string()), phrases, counts], _NAMES)


# ---- what tasks are given ----------------------------------------------------------------------------------------


def cell_bit(cells: np.ndarray | Column) -> np.ndarray | Column:
    """The bit of a cell in a bitmap, alike for arrays and columns; products of ranks and factors stay below 2**58."""
    low = RANKS - 1
    if isinstance(cells, Column):
        lang, before = F.shiftright(cells, LANG_SHIFT), F.shiftright(cells, RANK_BITS).bitwiseAND(low)
        mixed = lang * 0x5851F42D4D + before * 0x9E3779B97D + cells.bitwiseAND(low) * 0x7F4A7C15F5
        return F.shiftright(mixed, 20).bitwiseAND((1 << REST_BITS) - 1)
    mixed = (cells >> LANG_SHIFT) * 0x5851F42D4D + (cells >> RANK_BITS & low) * 0x9E3779B97D + (cells & low) * 0x7F4A7C15F5
    return mixed >> 20 & ((1 << REST_BITS) - 1)


@dataclass
class Ranked:
    """The frequent phrases of one length: by language those with a rank, in order, and bitmaps of the hashes of all others.

    ``cells`` are the ranked phrases' cells, sorted, and ``ranks`` their ranks; words have none. ``rest`` marks phrases without a
    cell by their text, ``rest_cells`` those with a cell by that.
    """

    names: dict[str, list[bytes]] = field(default_factory=dict)
    cells: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))
    ranks: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))
    rest: np.ndarray | None = None
    rest_cells: np.ndarray | None = None

    def beyond_cells(self, cells: np.ndarray) -> np.ndarray:
        """Which phrases with a cell, but no rank, may be frequent."""
        bits = cell_bit(cells)
        marks = self.rest_cells[bits >> 6] >> (bits & 63).astype(np.uint64)
        return (marks & np.uint64(1)).astype(bool)

    def beyond(self, phrase: bytes) -> bool:
        """If a phrase without a rank may be frequent."""
        from xxhash import xxh64_intdigest

        bit = xxh64_intdigest(phrase, 42) & ((1 << REST_BITS) - 1)
        return bool(int(self.rest[bit >> 6]) >> (bit & 63) & 1)


class Reader:
    """Gives each place of a block the rank of the phrase that starts there, -1 for one too rare, -2 for one beyond the ranks."""

    def __init__(self, levels: list[Ranked]):
        self.levels = levels
        self.langs = {lang: i for i, lang in enumerate(sorted(levels[0].names))}
        self.masks = [self._mask(level.cells) for level in levels]
        self.words = {lang: {word: i for i, word in enumerate(names)} for lang, names in levels[0].names.items()}

    @staticmethod
    def _address(cells: np.ndarray) -> np.ndarray:
        return ((cells.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MASK_BITS)).astype(np.int64)

    def _mask(self, cells: np.ndarray) -> np.ndarray:
        """Where ranked cells hash to: it spares most other cells the search."""
        mask = np.zeros(1 << MASK_BITS, dtype=bool)
        mask[self._address(cells)] = True
        return mask

    def word_ranks(self, lang: str, words: list[bytes]) -> np.ndarray:
        known = self.words.get(lang, {})
        ranks = np.fromiter(map(known.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        if self.levels[0].rest is not None:
            test = {word: self.levels[0].beyond(word) for word in {words[i] for i in np.flatnonzero(ranks < 0)} - {_BREAK}}
            for i in np.flatnonzero(ranks < 0):
                if test.get(words[i]):
                    ranks[i] = -2
        return ranks

    def next_cells(self, lang: str, shorter: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of phrases one word longer: cells, which of them have one, and which must be told by their text."""
        before, after = shorter[:-1], shorter[1:]
        ranked = (before >= 0) & (after >= 0)
        as_text = (before != -1) & (after != -1) & ~ranked
        cells = self.langs.get(lang, 0) << LANG_SHIFT | before << RANK_BITS | last
        return cells, ranked, as_text

    def count(self, lang: str, words: list[bytes], carried: int, size: int) -> tuple[np.ndarray, list[bytes]]:
        """The cells, and the phrases without a cell, of all phrases of ``size`` words that end after the carried words."""
        found = self.word_ranks(lang, words)
        word_ranks = found
        for k in range(2, size + 1):
            if len(found) < 2:
                return np.empty(0, dtype=np.int64), []
            cells, ranked, as_text = self.next_cells(lang, found, word_ranks[k - 1 :])
            if k == size:
                new = np.arange(len(cells)) + k > carried
                return cells[ranked & new], [b" ".join(words[i : i + k]) for i in np.flatnonzero(as_text & new)]
            own = self.levels[k - 1]
            hit, found = np.zeros(len(cells), dtype=bool), np.full(len(cells), -1, dtype=np.int64)
            likely = np.flatnonzero(ranked)
            likely = likely[self.masks[k - 1][self._address(cells[likely])]]
            if len(own.cells):
                place = np.minimum(np.searchsorted(own.cells, cells[likely]), len(own.cells) - 1)
                same = own.cells[place] == cells[likely]
                hit[likely[same]] = True
                found[likely[same]] = own.ranks[place[same]]
            if own.rest_cells is not None:
                others = np.flatnonzero(ranked & ~hit)
                found[others[own.beyond_cells(cells[others])]] = -2
            if own.rest is not None:
                for i in np.flatnonzero(as_text):
                    if own.beyond(b" ".join(words[i : i + k])):
                        found[i] = -2
        raise ValueError("phrases have two words at least")


def with_language(documents: DataFrame) -> DataFrame:
    return documents.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))


def frequent_words(documents: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of words that occur ``least`` times; the empty word has the number of all words of the language."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, totals = Counter(), Counter()
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, words, carried in blocks(batch):
                own = counts.setdefault(lang, Counter())
                own.update(words[carried:])
                totals[lang, b""] += len(words) - carried - own.pop(_BREAK, 0)
            if sum(map(len, counts.values())) > TEXTS:
                for lang, own in counts.items():
                    held = Counter({(lang, word): n for word, n in own.items()})
                    if held:
                        yield text_rows(held)
                counts = {}
        for lang, own in counts.items():
            held = Counter({(lang, word): n for word, n in own.items()})
            if held:
                yield text_rows(held)
        if totals:
            yield text_rows(totals)

    rows = with_language(documents).mapInArrow(run, _SCHEMA)
    counted = rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return stored(counted.where((F.col("n") >= least) | (F.col("phrase") == "")), "collocation-words")


def frequent_phrases(documents: DataFrame, levels: list[Ranked], size: int, least: int) -> DataFrame:
    """(cell, lang, phrase, n) of the phrases of ``size`` words that occur ``least`` times; only some have a cell."""
    spark = documents.sparkSession
    held = spark.sparkContext.broadcast(levels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, tiles, texts = Reader(held.value), Tiles(), Counter()
        for batch in batches:
            for lang, words, carried in blocks(batch):
                cells, phrases = reader.count(lang, words, carried, size)
                yield from tiles.add(cells)
                texts.update(zip(repeat(lang), phrases))
            if len(texts) > TEXTS:
                yield text_rows(texts)
                texts = Counter()
        yield from tiles.rest()
        if texts:
            yield text_rows(texts)

    def named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, before = held.value[0].names, held.value[size - 2].names
        langs = sorted(words)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for i, cell in enumerate(columns[0]):
                if cell is not None:
                    lang = langs[cell >> LANG_SHIFT]
                    head = before[lang][cell >> RANK_BITS & (RANKS - 1)]
                    columns[1][i] = lang
                    columns[2][i] = (head + b" " + words[lang][cell & (RANKS - 1)]).decode()
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _NAMES)

    counted = with_language(documents).mapInArrow(run, _SCHEMA).groupBy("cell", "lang", "phrase").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= least).mapInArrow(named, _SCHEMA), f"collocation-{size}")


def ranked(frequent: DataFrame, words: bool) -> Ranked:
    """Ranks for the ``RANKS`` most frequent phrases over all languages, bitmaps of the hashes of the others."""
    rows = frequent.where("phrase != ''")
    able = F.octet_length("phrase") <= RANKED_BYTES if words else F.col("cell").isNotNull()
    order = [F.desc("n"), F.col("lang"), F.col("phrase")]
    chosen = rows.where(able).orderBy(*order).limit(RANKS).collect()
    out = Ranked()
    places: list[tuple[int, int]] = []
    for row in chosen:
        names = out.names.setdefault(row["lang"], [])
        if not words:
            places.append((row["cell"], len(names)))
        names.append(row["phrase"].encode())
    if places:
        places.sort()
        out.cells, out.ranks = np.array(places, dtype=np.int64).T.copy()
    beyond = ~able
    if len(chosen) == RANKS:
        last = chosen[-1]
        later = F.struct((-F.col("n")).alias("n"), "lang", "phrase") > F.struct(
            F.lit(-last["n"]).cast("long").alias("n"), F.lit(last["lang"]), F.lit(last["phrase"])
        )
        beyond = beyond | later
    text_bit = F.xxhash64("phrase").bitwiseAND((1 << REST_BITS) - 1)
    others = rows.where(beyond)
    if words:
        out.rest = bitmap(others.select(text_bit.alias("bit")))
    else:
        out.rest = bitmap(others.where("cell IS NULL").select(text_bit.alias("bit")))
        out.rest_cells = bitmap(others.where("cell IS NOT NULL").select(cell_bit(F.col("cell")).alias("bit")))
    return out


def bitmap(bits: DataFrame) -> np.ndarray | None:
    """The set bits as 64-bit words of a map of fixed size, None if there are none."""
    marks = bits.selectExpr("shiftright(bit, 6) AS at", "shiftleft(1L, CAST(bit & 63 AS INT)) AS mark")
    found = marks.groupBy("at").agg(F.bit_or("mark").alias("marks")).collect()
    if not found:
        return None
    out = np.zeros(1 << (REST_BITS - 6), dtype=np.uint64)
    for row in found:
        out[row["at"]] = row["marks"] % 2**64
    return out


def scores(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all phrases of several words by their lowest-scoring cut.

    ``counts`` holds (lang, phrase, words, n) of every frequent phrase, so also of both parts of every cut.
    """
    cut = counts.where("words > 1").select(
        "lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    split = F.split("phrase", " ")

    def side(name: str, part: Column) -> Column:
        return F.struct(F.lit(name).alias("side"), F.array_join(part, " ").alias("part"))

    parts = cut.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.inline(
            F.array(
                side("l", F.slice(split, F.lit(1), F.col("k"))),
                side("r", F.slice(split, F.col("k") + 1, F.col("words") - F.col("k"))),
            )
        ),
    )
    of_parts = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("n"))
    sided = parts.join(of_parts, ["lang", "part"]).groupBy("lang", "phrase", "a", "k")
    cuts = sided.agg(*[F.max(F.when(F.col("side") == s, F.col("n"))).alias(s) for s in ("l", "r")])
    # Up to 38 digits; the quotient is at most a million.
    score = F.expr("CAST((CAST(a AS DECIMAL(20, 0)) * 2000000) DIV (CAST(l AS DECIMAL(20, 0)) + r) AS BIGINT)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("lowest")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "lowest.l", "lowest.r", "lowest.score")


def contained(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): for each phrase of several words inside longer frequent ones, the largest count of these."""
    longer = counts.where("words > 2").select(
        "lang", "words", F.col("n").alias("longer"), F.split("phrase", " ").alias("split"),
        F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"),
    )
    inner = longer.select(
        "lang", "longer", "split", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("first")
    )
    phrase = F.array_join(F.slice("split", F.col("first"), F.col("size")), " ").alias("phrase")
    return inner.select("lang", phrase, "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))


def phrase_counts(documents: DataFrame, least: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of all phrases of one to four words that occur ``least`` times, and (lang, n) of all words."""
    ship(documents.sparkSession)
    words = frequent_words(documents, least)
    levels = [ranked(words, True)]
    counts = words.where("phrase != ''").select("lang", "phrase", F.lit(1).alias("words"), "n")
    for size in range(2, MOST_WORDS + 1):
        found = frequent_phrases(documents, levels, size, least)
        counts = counts.unionByName(found.select("lang", "phrase", F.lit(size).alias("words"), "n"))
        if size < MOST_WORDS:
            levels.append(ranked(found, False))
    return counts, words.where("phrase = ''").select("lang", "n")


def collocations(documents: DataFrame, least: int = LEAST_COUNT, best: int = BEST) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A null text is empty, a null language is ``und``, and repeated rows count as often. A language whose phrases are all too rare has
    no rows. Phrases that a longer one explains by four fifths of their occurrences are left out.
    """
    counts, totals = phrase_counts(documents, least)
    known = scores(counts).join(contained(counts), ["lang", "phrase"], "left")
    small = F.lit(80).cast("decimal(20,0)") * F.col("a")
    open_ = known.where(F.col("longer").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("longer") < small))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = open_.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
