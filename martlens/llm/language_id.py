"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed n-grams of its letters (1 to 3 letters, word ends included), weighted by log counts and by
how rare each n-gram is among all training documents, scaled to length 1. For each language a bounded sample of its documents
is clustered; a text gets the language of the centroid with the largest cosine, and is rejected if even that is small.

How small depends on how many different n-grams a text has: a long text of any letters shares many n-grams with a centroid, but
has a far smaller cosine than the long texts the language was learned from (``floors``). N-grams have 65,536 buckets, as a long
text in an unlearned script would meet the n-grams of the centroids in fewer ones by chance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlens.llm.shared import code_points, ship, small_batches, small_side, stored

SIZE = 65536
CLUSTERS = 4
#: The clustering reads at most so many documents of a language; everything else reads all of them.
PER_LANGUAGE = 400
ROUNDS = 15
REJECT_BELOW = 0.1
#: A text is rejected below so much of the cosine that all but ``STRAY`` of the training texts of its size reach with the rest of
#: their language.
SHARE = 0.5
STRAY = 0.02
#: Sizes are powers of two of different n-grams; a size with fewer training texts of a language takes the bound of the size below.
SIZES = 18
LEAST_TEXTS = 20
#: Texts of up to 127 different n-grams are rejected below this share of the common bound: a clean one of common words has a small cosine.
SMALL_SIZE = 7
SMALL_SHARE = 0.4
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def is_letter(codes: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0][codes]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str, size: int = SIZE) -> np.ndarray:
    """How often each hashed n-gram occurs; whatever is no letter counts as one blank, and blanks alone are no n-gram."""
    codes = code_points(text.lower())
    letter = is_letter(codes)
    # Of a run of other characters only the first stays, as a blank.
    keep = letter | np.concatenate(([True], letter[:-1]))
    blank = np.uint32(32)
    codes = np.concatenate(([blank], np.where(letter, codes, blank)[keep], [blank])).astype(np.uint32)
    seen = codes != blank
    one = codes * np.uint32(2654435761)
    two = (one[:-1] ^ (codes[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
    three = (two[:-1] ^ (codes[2:] * np.uint32(668265263))) * np.uint32(374761393)
    shift = np.uint32(32 - size.bit_length() + 1)
    parts = [one[seen] >> shift, two[seen[:-1] | seen[1:]] >> shift, three[seen[:-2] | seen[1:-1] | seen[2:]] >> shift]
    return np.bincount(np.concatenate(parts), minlength=size)


@dataclass
class LanguageModel:
    """Weights of the n-grams, centroids as rows of length 1, and of each row the language and the smallest cosine by size.

    No rows: nothing was learned.
    """

    weights: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    floors: np.ndarray

    @cached_property
    def by_gram(self) -> np.ndarray:
        return np.ascontiguousarray(self.centroids.T)

    def entries(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The places and values of a text's vector that are not 0."""
        counts = gram_counts(text, len(self.weights))
        grams = np.flatnonzero(counts)
        raw = np.log1p(counts[grams]) * self.weights[grams]
        return grams, (raw / max(float(np.linalg.norm(raw)), 1e-12)).astype(np.float32)

    def predict(self, texts: list[str | None], reject_below: float = REJECT_BELOW) -> list[tuple[str, float, bool]]:
        """Language, cosine clipped to 0..1, and if it is too small; ``und``, 0, True without a letter or a learned language."""
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        by_gram = self.by_gram
        for i, text in enumerate(texts):
            if self.languages and has_letter(text):
                grams, values = self.entries(text)
                cosines = values @ by_gram[grams]
                best = int(cosines.argmax())
                size, cosine = size_class(len(grams)), float(min(1.0, max(0.0, cosines[best])))
                least = reject_below * (SMALL_SHARE if size <= SMALL_SIZE else 1)
                out[i] = (self.languages[best], cosine, cosine < max(least, float(self.floors[best, size])))
        return out


def size_class(grams: int) -> int:
    return min(grams.bit_length(), SIZES - 1)


#: A vector by its entries that are not 0: their places and values.
Entries = tuple[np.ndarray, np.ndarray]


def summed(rows: list[Entries], size: int, kind: type) -> np.ndarray:
    total = np.zeros(size, dtype=kind)
    for places, values in rows:
        total[places] += values
    return total


def smallest_cosines(vectors: np.ndarray | list[Entries], size: int = SIZE) -> np.ndarray:
    """By size, ``SHARE`` of a low cosine of a language's vectors with the sum of its other ones; 0 where too few tell.

    Vectors are given by their entries, or whole as the rows of an array of at most ``size`` columns.
    """
    rows = [(np.flatnonzero(v), v[v != 0]) for v in vectors] if isinstance(vectors, np.ndarray) else vectors
    total = summed(rows, size, np.float64)
    own = np.array([np.square(values, dtype=np.float64).sum() for _, values in rows])
    dots = np.array([values @ total[places] for places, values in rows])
    rest = np.sqrt(np.maximum(total @ total - 2 * dots + own, 0))
    cosines = (dots - own) / np.maximum(rest, 1e-12)
    sizes = np.array([size_class(len(places)) for places, _ in rows])
    out = np.zeros(SIZES)
    for at in range(1, SIZES):
        here = cosines[sizes == at]
        out[at] = SHARE * max(0.0, float(np.quantile(here, STRAY))) if len(here) >= LEAST_TEXTS else out[at - 1]
    return out


def cluster(rows: list[Entries], size: int, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of length 1 by cosine k-means, started from rows that lie far from each other; the same for the same rows."""

    def centre(some: list[Entries]) -> np.ndarray:
        mean = summed(some, size, np.float32) / len(some)
        return mean / max(float(np.linalg.norm(mean)), 1e-12)

    def cosines(centres: np.ndarray) -> np.ndarray:
        by_place = np.ascontiguousarray(centres.T)
        return np.stack([values @ by_place[places] for places, values in rows])

    centres = [centre(rows)]
    nearest = cosines(centres[0])
    while len(centres) < min(clusters, len(rows)):
        centres.append(summed([rows[int(nearest.argmin())]], size, np.float32))
        nearest = np.maximum(nearest, cosines(centres[-1]))
    found = np.stack(centres)
    for _ in range(rounds):
        own = cosines(found).argmax(axis=1)
        for i in range(len(found)):
            if (own == i).any():
                found[i] = centre([row for row, at in zip(rows, own) if at == i])
    return found


def training_part(documents: DataFrame) -> DataFrame:
    """Documents with a language and a text whose crc32(doc_id as text) mod 3 is 0 or 2; a null doc_id never trains."""
    rest = F.crc32(F.col("doc_id").cast("string")) % 3
    return documents.where("lang IS NOT NULL AND text IS NOT NULL").where(rest != 1)


def learn(
    training: DataFrame, size: int = SIZE, clusters: int = CLUSTERS, per_language: int = PER_LANGUAGE
) -> LanguageModel:
    """Weights over all training rows, centroids from at most ``per_language`` rows of each language.

    The rows of a language are chosen by a hash of doc_id and text, so reruns agree. What comes to the driver is one vector
    of ``size`` weights and ``clusters`` vectors for each language.
    """
    spark = training.sparkSession
    ship(spark)
    small_batches(spark)
    rows = training.select("doc_id", "text", "lang")

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, holding = 0, np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                if has_letter(text := value.as_py()):
                    documents += 1
                    holding[:-1] += gram_counts(text, size) > 0
        holding[-1] = documents
        held = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(holding[held])], ["gram", "n"])

    counted = rows.select("text").mapInArrow(frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    holding = np.zeros(size + 1)
    for row in counted.collect():
        holding[row["gram"]] = row["n"]
    weights = np.log((1.0 + holding[-1]) / (1.0 + holding[:-1])) + 0.1

    order = F.xxhash64(F.lit(11), "doc_id", "text")
    sizes = small_side(stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes"))
    # A share of each language that holds about twice the bound, then the bound itself.
    share = F.lit(2.0 * per_language + 50) / F.col("n") * F.lit(2.0**32)
    likely = rows.withColumn("order", order).join(sizes, "lang").where(F.pmod("order", F.lit(2**32)) < share)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id", "text"))
    chosen = likely.withColumn("place", place).where(F.col("place") <= per_language).select("lang", "text")

    blank = LanguageModel(weights, np.zeros((0, size), dtype=np.float32), [], np.zeros((0, SIZES)))

    def centroids(group):
        import pandas as pd

        texts = [text for text in sorted(group["text"]) if has_letter(text)]
        if not texts:
            return pd.DataFrame({"lang": [], "centroid": [], "floors": []})
        # By their entries: as whole rows of ``size`` numbers they took more than all else that a worker holds.
        entries = [blank.entries(text) for text in texts]
        found = [row.astype("<f4").tobytes() for row in cluster(entries, size, clusters)]
        floors = smallest_cosines(entries, size).tolist()
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": found, "floors": [floors] * len(found)})

    kinds = "lang string, centroid binary, floors array<double>"
    learned = chosen.groupBy("lang").applyInPandas(centroids, kinds).collect()
    learned.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    if not learned:
        return blank
    rows_of = np.stack([np.frombuffer(bytes(r["centroid"]), dtype="<f4") for r in learned])
    return LanguageModel(weights, rows_of, [r["lang"] for r in learned], np.array([r["floors"] for r in learned]))


def shared_model(spark: SparkSession, model: LanguageModel):
    return spark.sparkContext.broadcast((model.weights, model.centroids, model.languages, model.floors))


def predict(documents: DataFrame, model: LanguageModel, reject_below: float = REJECT_BELOW) -> DataFrame:
    """The documents' columns, then lang_pred, score and rejected; an existing column of such a name is replaced.

    A null, empty or letterless text is ``und`` with score 0 and rejected. Others are rejected below ``reject_below`` or the
    smallest cosine that the language's texts of such a size have, whichever is larger.
    """
    spark = documents.sparkSession
    ship(spark)
    small_batches(spark)
    held = shared_model(spark, model)
    added = ["lang_pred", "score", "rejected"]
    frame = documents.drop(*added)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(*held.value)
        at = frame_names.index("text")
        for batch in batches:
            # One text at a time, so that a batch of long texts is not held twice.
            found = [own.predict([text.as_py()], reject_below)[0] for text in batch.column(at)]
            columns = [
                pa.array([lang for lang, _, _ in found], pa.string()),
                pa.array([score for _, score, _ in found], pa.float64()),
                pa.array([far for _, _, far in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*frame_names, *added])

    frame_names = frame.columns
    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in frame.schema)
    return frame.mapInArrow(run, f"{kinds}, lang_pred string, score double, rejected boolean")


def identify(documents: DataFrame, reject_below: float = REJECT_BELOW) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document, learned from the part that is not held out."""
    model = learn(training_part(documents))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return predict(documents.select("doc_id", "text"), model, reject_below).select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )
