"""Token counts as an exact histogram of encoded lengths.

Documents are encoded where they are read and only their lengths leave the task. The histogram has one row per length that
occurs; sums over all longer and all shorter lengths then answer totals, quantiles and totals after truncation for every
context limit without touching a document again. A corpus of T tokens has at most sqrt(2 T) + 1 different lengths.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.shared import model_path, ship, stored

MODEL = "byte_bpe_50k.tiktoken"
BLOCK = 4096


def length_reader(model: str):
    """A function from a text to its number of byte-level BPE tokens; special token strings count as ordinary text."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(model_path(model), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def encoded_lengths(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """One row ``n_tokens`` per document; a null or empty text has 0."""
    ship(documents.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = length_reader(model)
        for batch in batches:
            counts = [length(text) if (text := value.as_py()) else 0 for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n_tokens"])

    return documents.select("text").mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs), one row per length; null lengths are left out."""
    return lengths.where("n_tokens IS NOT NULL").groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """What every limit that is a length of the histogram answers.

    ``docs_within`` and ``tokens_within`` sum the documents of at most that length, ``docs_beyond`` and ``tokens_beyond`` the
    longer ones; ``truncated_tokens`` is the total when every document is cut to the limit; ``share_within`` is the rank of the
    length among all documents, so its quantiles. An empty histogram gives no rows.

    Lengths are summed in blocks of 4,096 lengths, in parallel, and the blocks' totals once more. The histogram is written once
    and read for both, so no text is encoded twice.
    """
    histogram = stored(histogram, "length-histogram")
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs")
    )
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(earlier), F.lit(0)).alias("earlier_docs"),
        F.coalesce(F.sum("block_tokens").over(earlier), F.lit(0)).alias("earlier_tokens"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    within = rows.select(
        "block", "n_tokens", "n_docs", F.sum("n_docs").over(inside).alias("docs"), F.sum("tokens").over(inside).alias("sum")
    )
    docs, tokens = F.col("docs") + F.col("earlier_docs"), F.col("sum") + F.col("earlier_tokens")
    return within.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        docs.alias("docs_within"),
        tokens.alias("tokens_within"),
        (F.col("all_docs") - docs).alias("docs_beyond"),
        (F.col("all_tokens") - tokens).alias("tokens_beyond"),
        (tokens + (F.col("all_docs") - docs) * F.col("n_tokens")).alias("truncated_tokens"),
        (docs / F.col("all_docs")).alias("share_within"),
    )


def answers(table: DataFrame, limits: list[int]) -> DataFrame:
    """One row per given limit, which need not be a length: documents within it, all tokens and tokens after truncation.

    The sums are looked up in the limit table, at the greatest length that the limit does not exceed.
    """
    none = F.lit(0).cast("long")
    docs = F.coalesce(F.max(F.col("docs_within") + F.col("docs_beyond")), none)
    tokens = F.coalesce(F.max(F.col("tokens_within") + F.col("tokens_beyond")), none)
    asked = []
    for limit in limits:
        length = F.when(F.col("n_tokens") <= limit, F.col("n_tokens"))
        within, tokens_within, beyond = (
            F.max_by(name, length) for name in ("docs_within", "tokens_within", "docs_beyond")
        )
        asked.append(
            F.struct(
                F.lit(limit).cast("long").alias("context_limit"),
                F.coalesce(within, none).alias("docs_within"),
                docs.alias("docs"),
                tokens.alias("tokens"),
                (F.coalesce(tokens_within, none) + F.coalesce(beyond, docs) * limit).alias("truncated_tokens"),
            )
        )
    return table.agg(F.array(*asked).alias("rows")).select(F.inline("rows"))


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """For each share in (0, 1] the least length that at least this share of the documents does not exceed."""
    found = [
        F.struct(
            F.lit(float(share)).alias("share"),
            F.min(F.when(F.col("share_within") >= share, F.col("n_tokens"))).alias("n_tokens"),
        )
        for share in shares
    ]
    return table.agg(F.array(*found).alias("rows")).select(F.inline("rows"))
