"""Secret scans judged by how widely a value is copied.

Three fixed patterns give the base spans. Long mixed tokens without such a context are candidates too. The hash of every
value is counted by the distinct repositories and owners it occurs in. A copied example is what many owners share, or what
several owners share over many repositories; what a single owner repeats over its own repositories is not. Other values that
look random are live-looking credentials. Live-looking tokens other than plain hexadecimal become spans of the kind ``live``;
base spans stay whatever their verdict.

Everything is expressions and joins inside Spark. Positions are counted in code points: the text is split by the pattern, and
the lengths of the pieces before a match add up to its start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.shared import small_side, stored, unused

# The base patterns and their least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ["assign", "access", "hex", "live"]

TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
COPIED_BY = 3
# Repositories that make a copied example of a value which at least two owners hold.
COPIED_IN = 5
DISTINCT_CHARACTERS = 8


def found(text: F.Column, kind: int, pattern: str, group: int) -> F.Column:
    """Every match: its kind, its number, the lengths of the gap before it and of itself, and its value."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    zipped = F.arrays_zip(hits.alias("hit"), values.alias("value"))
    return F.transform(
        zipped,
        lambda match, i: F.struct(
            F.lit(kind).alias("rank"),
            i.alias("number"),
            F.length(F.get(gaps, i)).alias("gap"),
            F.length(match["hit"]).alias("size"),
            match["value"].alias("value"),
        ),
    )


def matches(text: F.Column) -> F.Column:
    """All matches of all patterns; texts that cannot match are told by a cheaper test first."""
    nothing = F.expr("CAST(array() AS array<struct<rank:int,number:int,gap:int,size:int,value:string>>)")
    lower = F.lower(text)
    words = ["password", "passwd", "secret", "token", "apikey", "api_key"]
    any_word = lower.contains(words[0])
    for word in words[1:]:
        any_word = any_word | lower.contains(word)
    return F.concat(
        F.when(any_word, found(text, 0, ASSIGN, 2)).otherwise(nothing),
        F.when(text.contains("AKIA"), found(text, 1, ACCESS, 0)).otherwise(nothing),
        F.when(text.rlike(HEX), found(text, 2, HEX, 0)).otherwise(nothing),
        F.when(text.rlike(TOKEN), found(text, 3, TOKEN, 0)).otherwise(nothing),
    )


def looks_random(value: F.Column) -> F.Column:
    return (
        (F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT_CHARACTERS)
        & value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
    )


def scanned(documents: DataFrame, owner: F.Column, repository: F.Column) -> DataFrame:
    """One stored row per document, without its text: an own number, who it belongs to and its matches."""
    text = F.coalesce(F.col("text"), F.lit(""))
    frame = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text), 256).alias("key"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        matches(text).alias("matches"),
    )
    return stored(frame, "secret-matches")


def spans(scan: DataFrame, copied_by: int = COPIED_BY, copied_in: int = COPIED_IN) -> DataFrame:
    """One row per span: row, rank (place in KINDS), start, end, value, and how many owners and repositories hold the value.

    ``copied`` tells values of at least ``copied_by`` owners, or of two owners and at least ``copied_in`` repositories, ``live``
    the others that look random. Matches too short for their kind are dropped after they took part in counting positions. A null
    owner or repository counts as one of its own.
    """
    each = scan.where(F.size("matches") > 0).select("row", "key", "owner", "repository", F.inline("matches"))
    so_far = Window.partitionBy("row", "rank").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.col("size")).cast("long")).over(so_far)
    least = F.when(F.col("rank") == 0, F.length("value") >= ASSIGN_LEAST).when(
        F.col("rank") == 1, F.length("value") >= ACCESS_LEAST
    )
    only_hex = F.col("value").rlike("^[0-9a-f]+$")
    placed = (
        each.withColumn("end", end)
        .withColumn("start", F.col("end") - F.col("size"))
        .withColumn("random", looks_random(F.col("value")))
        .where(least.when(F.col("rank") == 2, F.length("value") >= HEX_LEAST).otherwise(F.col("random") & ~only_hex))
        .withColumn("hash", F.sha2("value", 256))
        .drop("number", "gap", "size")
    )
    owned = (
        placed.groupBy("hash", "owner", "repository")
        .agg(F.count("*").alias("times"))
        .groupBy("hash")
        .agg(F.countDistinct("owner").alias("owners"), F.countDistinct("repository").alias("repositories"))
    )
    widely = (F.col("owners") >= copied_by) | ((F.col("owners") >= 2) & (F.col("repositories") >= copied_in))
    judged = placed.join(owned, "hash").withColumn("copied", widely)
    judged = judged.withColumn("live", F.col("random") & ~F.col("copied"))
    return judged.where((F.col("rank") < 3) | F.col("live")).drop("random", "owner", "repository")


def secret_scan(
    documents: DataFrame,
    owner: F.Column | None = None,
    repository: F.Column | None = None,
    copied_by: int = COPIED_BY,
    copied_in: int = COPIED_IN,
) -> DataFrame:
    """One row per document: counts of base spans, a digest of them, all spans as text, and counts by verdict.

    ``span_owners`` and ``span_repositories`` hold, in the order of the spans, how many owners and repositories have the value.

    The owner is the source and the repository the source and language unless given. A null text is empty. Repeated rows are
    each reported, with the same spans. Spans are ``kind:start:end``, by start, then kind, comma-joined; no span gives "".
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    scan = scanned(documents, owner, repository)
    span = F.struct("start", "rank", "end", "live", "copied", "owners", "repositories")
    per_row = spans(scan, copied_by, copied_in).groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    kinds = F.array(*[F.lit(kind) for kind in KINDS])

    def joined(found: F.Column) -> F.Column:
        text = F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"]))
        return F.coalesce(F.array_join(text, ","), F.lit(""))

    def each(name: str) -> F.Column:
        return F.coalesce(F.array_join(F.transform("spans", lambda s: s[name].cast("string")), ","), F.lit("")).alias(f"span_{name}")

    def counted(test) -> F.Column:
        return F.coalesce(F.size(F.filter("spans", test)), F.lit(0)).cast("long")

    def of_kind(rank: int):
        return lambda s: s["rank"] == rank

    base = F.filter("spans", lambda s: s["rank"] < 3)
    return (
        scan.select("row", "doc_id")
        .join(per_row, "row", "left")
        .select(
            "doc_id",
            *[counted(of_kind(rank)).alias(f"n_{KINDS[rank]}") for rank in range(3)],
            F.sha2(joined(base), 256).alias("base_sha256"),
            joined(F.col("spans")).alias("spans"),
            counted(lambda s: s["live"]).alias("n_live"),
            counted(lambda s: s["copied"]).alias("n_copied"),
            each("owners"),
            each("repositories"),
        )
    )


def redacted(
    documents: DataFrame, mark: str = "<secret>", copied_by: int = COPIED_BY, copied_in: int = COPIED_IN
) -> DataFrame:
    """The documents with every span replaced by a mark, but for copied examples; n_chars follows the text.

    Overlapping spans become one mark. Documents without such spans, null texts included, pass unchanged. The texts stay where
    they are, unless the cuts are too many to be sent to them.
    """
    scan = scanned(documents, F.col("source"), F.concat_ws("/", "source", "lang"))
    chosen = spans(scan, copied_by, copied_in).where(~F.col("copied")).select("key", "start", "end").distinct()
    by_start = Window.partitionBy("key").orderBy("start", "end")
    reached = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reached.isNull() | (F.col("start") >= reached)).cast("int")
    whole = (
        chosen.withColumn("opens", opens)
        .withColumn("group", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("key", "group")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    kept_from = F.coalesce(F.lag("end").over(Window.partitionBy("key").orderBy("start")), F.lit(0))
    cuts = (
        whole.withColumn("from", kept_from)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("from", "start"))).alias("cuts"), F.max("end").alias("last"))
    )
    # All names that are added are beside the documents' own, which may be anything: one struct under a name not in use.
    own = unused("_secrets", documents.columns)
    cuts = stored(cuts.select(F.struct("key", "cuts", "last").alias(own)), "secret-cuts")
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.sha2(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text), 256)
    names = documents.columns
    joined = documents.join(small_side(cuts, F.size(f"{own}.cuts")), key == F.col(f"{own}.key"), "left")
    pieces = F.transform(
        f"{own}.cuts",
        lambda c: F.concat(F.substr(text, (c["from"] + 1).cast("int"), (c["start"] - c["from"]).cast("int")), F.lit(mark)),
    )
    new = F.concat(F.array_join(pieces, ""), F.substr(text, (F.col(f"{own}.last") + 1).cast("int"), F.length(text)))
    changed = F.col(own).isNotNull()
    # The length is taken from the finished text in a second step: within one step the new text stands in for the old one.
    redone = joined.withColumn("text", F.when(changed, new).otherwise(F.col("text")))
    length = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return redone.withColumn("n_chars", length).select(*names)
