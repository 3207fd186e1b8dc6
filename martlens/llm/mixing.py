"""Mixing sources to target weights by Sainte-Laguë apportionment.

All sources share a number of equal blocks of words: block after block goes to the source with the highest quotient
``target / (2 k - 1)`` for its k-th block. The blocks of a source go to its shards in the same way, by their sizes. Inside a
shard the documents are laid end to end in a seeded order and cut into blocks; the quota is spread evenly over the blocks from
a seeded start, so some are taken once more than others.

A text is read once; after that only one small row per document moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.shared import small_side, stored, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_TIMES = 2
BLOCK_WORDS = 8
SHARD_WORDS = 4_000_000
SEED = 20


def hashed(*parts) -> F.Column:
    """A number of 60 bits from an MD5 digest of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def ranked(names: DataFrame, column: str) -> DataFrame:
    """The distinct rows with ``rank``, their place from 0 in order of the column, nulls last.

    Sorted in parallel; a row's place is its place in its partition plus the sizes of the partitions before.
    """
    place = F.monotonically_increasing_id()
    sorted_ = stored(names.orderBy(F.col(column).asc_nulls_last()).withColumn("place", place), "ranked")
    part = F.shiftright("place", 33)
    sizes = sorted_.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col("part").alias("_part"), before.alias("before"))
    inside = F.col("place") - F.shiftleft(part, 33)
    return (
        sorted_.join(offsets, part == F.col("_part")).withColumn("rank", inside + F.col("before")).drop("place", "_part", "before")
    )


def targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most_times: int = MOST_TIMES
) -> DataFrame:
    """Adds weight and target to (source, source_size, rank).

    The targets are weight times one level, but at most ``most_times`` the source's size; the level makes them add up to
    ``share`` of all sizes. It is raised until no further source is capped: a few passes over the sources, of which each
    returns two sums.
    """
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    table = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most_times)
    total = share * (table.agg(F.sum("source_size").alias("n")).first()["n"] or 0)
    level, capped = 0.0, -1
    while True:
        above = F.col("cap") < F.lit(level) * F.col("weight")
        row = table.agg(
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)).alias("used"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("open"),
            F.count(F.when(above, 1)).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["open"]:
            break
        capped, level = row["capped"], (total - row["used"]) / row["open"]
    target = F.least(F.col("cap").cast("double"), F.lit(float(level)) * F.col("weight"))
    return table.withColumn("target", target).drop("cap")


def apportion(table: DataFrame, group: list[str], key: str, weight: str, seats: str) -> DataFrame:
    """(group, key, quota): the seats of each group dealt to its rows by the highest quotients ``weight / (2 k - 1)``.

    Ties go to the smaller key. With m rows of positive weight, the divisor lies between those that deal half of m seats too
    few and too many; only the seats between these two bounds, 2 m at most, have to be compared. Rows without weight get 0.
    """
    sums = table.groupBy(*group).agg(
        F.sum(weight).cast("double").alias("_weight"),
        F.count(F.when(F.col(weight) > 0, 1)).alias("_rows"),
    )
    w, half = F.col(weight).cast("double"), F.col("_rows") / 2

    def rounded(seat_count: F.Column) -> F.Column:
        shared = F.floor(F.greatest(seat_count, F.lit(0.0)) * w / F.col("_weight") + 0.5)
        return F.when(w > 0, shared).otherwise(0).cast("long")

    bounded = table.join(sums, group).withColumn("_low", rounded(F.col(seats) - half)).withColumn("_high", rounded(F.col(seats) + half))
    over = Window.partitionBy(*group)
    open_ = bounded.withColumn("_open", F.col(seats) - F.sum("_low").over(over)).where(F.col("_high") > F.col("_low"))
    seat = F.explode(F.sequence(F.col("_low") + 1, F.col("_high")))
    compared = open_.select(*group, key, "_open", w.alias("_w"), seat.alias("_seat"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy((F.col("_w") / (2 * F.col("_seat") - 1)).desc(), key))
    won = compared.withColumn("_place", place).where(F.col("_place") <= F.col("_open"))
    more = won.groupBy(*group, key).agg(F.count("*").alias("_more"))
    same = [F.col(f"low.{c}").eqNullSafe(F.col(f"more.{c}")) for c in [*group, key]]
    return (
        bounded.alias("low")
        .join(more.alias("more"), same, "left")
        .select(*[F.col(f"low.{c}") for c in [*group, key]], (F.col("low._low") + F.coalesce("_more", F.lit(0))).alias("quota"))
    )


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most_times: int = MOST_TIMES,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) of every document.

    Sources are ordered by code point, null (a source of its own) last. A null or empty text has size 0 and takes 0. A document
    takes at most ``most_times`` its size. Documents in a shard are laid out by a hash of seed, doc_id and size; rows alike in
    all of these are interchangeable. The shards of a source are as many as it has ``shard_words`` words and documents, so a
    large source is worked on by many tasks.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = stored(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        ),
        "sizes",
    )
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = targets(ranked(by_source, "source"), weights, share, most_times)
    # All sources share one mix; a rank is a join key without nulls, as no two sources have the same.
    sources = sources.withColumn("mix", F.lit(0))
    blocks = F.round(F.sum("source_size").over(Window.partitionBy("mix")) * share / block_words).cast("long")
    quotas = apportion(sources.withColumn("blocks", blocks), ["mix"], "rank", "target", "blocks")
    quotas = quotas.select("rank", F.col("quota").alias("blocks"))
    shard_count = F.ceil((F.col("source_size") + F.col("n_docs")) / shard_words).cast("long")
    sources = stored(sources.join(quotas, "rank").withColumn("shards", shard_count), "sources")

    known = small_side(sources.select(F.col("source").alias("_source"), "rank", "source_size", "target", "shards"))
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    placed = sizes.join(known, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "rank",
        F.pmod(hashed(F.lit(seed), F.lit("shard"), doc), "shards").alias("shard"),
        hashed(F.lit(seed), F.lit("order"), doc, F.col("size")).alias("order"),
    )
    shards = placed.groupBy("rank", "shard").agg(F.sum("size").alias("shard_size"))
    shards = shards.join(sources.select("rank", "blocks"), "rank")
    shard_quotas = apportion(shards, ["rank"], "shard", "shard_size", "blocks")
    parts = (
        shards.join(shard_quotas, ["rank", "shard"])
        .withColumn("held", F.ceil(F.col("shard_size") / block_words).cast("long"))
        .select(
            F.col("rank").alias("_rank"),
            F.col("shard").alias("_shard"),
            "held",
            F.least("quota", F.col("held") * most_times).alias("quota"),
            F.pmod(hashed(F.lit(seed), F.lit("start"), "rank", "shard"), F.greatest("held", F.lit(1))).alias("start"),
        )
    )
    laid = Window.partitionBy("rank", "shard").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.withColumn("end", F.sum("size").over(laid))

    def taken_before(position: F.Column) -> F.Column:
        block = F.floor(position / block_words)

        def chosen(number: F.Column) -> F.Column:
            return F.floor((number * F.col("quota") + F.col("start")) / F.greatest("held", F.lit(1)))

        rest = position - block * block_words
        return chosen(block) * block_words + rest * (chosen(block + 1) - chosen(block))

    taken = F.when(F.col("size") > 0, taken_before(F.col("end")) - taken_before(F.col("end") - F.col("size"))).otherwise(0)
    same = (F.col("rank") == F.col("_rank")) & (F.col("shard") == F.col("_shard"))
    return ends.join(parts, same).select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(documents: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The documents as the mix takes them: whole, and 0 to 2 times each.

    A document that takes 1.3 times its words comes once, or with a chance of 0.3 by a seeded hash twice, so that the words of
    a source add up to its target but for chance. Documents without words are not taken. Repeated doc_ids share one decision.
    """
    own, times, copies, copy = (unused(name, documents.columns) for name in ("_id", "_times", "_copies", "_copy"))
    decided = mix(documents, seed=seed, **options).groupBy(F.col("doc_id").alias(own)).agg(
        F.max(F.col("taken") / F.greatest("size", F.lit(1))).alias(times)
    )
    chance = hashed(F.lit(seed), F.lit("times"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) / F.lit(2.0**60)
    joined = documents.join(decided, F.col("doc_id").eqNullSafe(F.col(own)))
    joined = joined.withColumn(copies, F.floor(F.col(times) + chance).cast("int"))
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    kept = joined.where(has_words & (F.col(copies) > 0)).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return kept.select(*[F.col(name) for name in documents.columns])
