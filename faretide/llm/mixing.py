"""Mixing sources to target weights by weighted sampling without replacement, in SQL functions.

Every source gets a target of words by its weight, at most ``max_epochs`` times what it has; what
a full source leaves is shared by weight among the others. A source first gives whole epochs.
The words still missing come from documents in the order of exponential keys
``-ln(u) / quality`` (Efraimidis and Spirakis), summed up to the budget; the document at the
budget's edge gives the words that are missing.

``u`` is a hash of the id and a seed, so reruns agree and lost tasks come back alike. Keys are cut
into bins of at most about ``BIN_ROWS`` documents: sums of bins are added up in a small table, and only
the documents of one bin are sorted in one place. Bins are of equal width in the key's logarithm.
Quality only shifts that, so whatever the qualities, no bin has more than a share of ``exp(-1) * ln
2 / 2 ** bits`` of a source, and ``bits`` follows from the source's size. Rows of one key (NULL ids,
or an id on many rows) share a bin all the same: a bin that is counted to be larger is cut again by
its keys, and these by a hash of the row's number. A source or an id with any share of all rows is
thereby spread. From ``MOST_BINS`` times ``BIN_ROWS`` rows on bins grow instead of their number, as
a source's table of bins is sorted in one task; so is the table of sources.

Defined results: a NULL, empty or white text has size 0 and gives nothing. A NULL source is one
source of its own, last in order. NULL ids share one key. Rows that share a key are taken in order
of id and size, or by chance where there are more than a bin holds. Rows that repeat an id are
documents of their own. An empty table gives no rows. Very long texts count whole. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

from math import ceil, exp, log, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faretide.session import numbered, stage

WORD = r"[^\x20\x09-\x0D]+"
BIN_ROWS = 500
#: Bins are larger where a source has more rows than these would be of.
MOST_BINS = 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mean_length_quality(text: Column, size: Column) -> Column:
    """1 for texts whose words have 3 to 10 bytes on average, as prose has, else 0.5."""
    mean = F.octet_length(text) / F.greatest(size, F.lit(1)) - 1
    return F.when(mean.between(3, 10), 1.0).otherwise(0.5)


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of a hash."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), key.cast("string"))), 1, 13), 16, 10)
    return (bits.cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...], percent: int, max_epochs: int
) -> DataFrame:
    """``(source, source_size, rows, target)`` from ``(source, source_size, rows)``.

    With sources in the order in which they fill up, the first k are full if the k-th's limit is
    below its share of what the earlier ones leave.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    filled = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(0, Window.unboundedFollowing)
    limit = F.col("source_size") * F.lit(float(max_epochs))
    every = Window.partitionBy()
    return (
        sizes.withColumn(
            "weight", F.element_at(turn, ((F.row_number().over(order) - 1) % len(weights) + 1))
        )
        .withColumn("limit", limit)
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn(
            "level",
            (F.sum("source_size").over(every) * percent / 100
             - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            / F.sum("weight").over(after),
        )
        .withColumn("full", F.col("ratio") <= F.col("level"))
        .withColumn("level", F.min(F.when(~F.col("full"), F.struct("ratio", "level"))).over(every))
        .select(
            "source", "source_size", "rows",
            F.when(F.col("full"), F.col("limit"))
            .otherwise(F.col("level.level") * F.col("weight")).alias("target"),
        )
    )


def binned(rows: DataFrame, most: int, bin_rows: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their place ``(bin, cut, sub)`` in the order of keys, and each place's words.

    ``most`` is the largest source's number of rows.
    """
    bits = max(0, ceil(log2(max(1.0, most * exp(-1) * log(2) / bin_rows))))
    placed = rows.withColumn("bin", F.floor(F.log2("key") * F.lit(float(1 << bits))).cast("long"))
    counted = stage(
        placed.groupBy("source", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")),
        "bins",
    )
    large = counted.where(F.col("n") > 2 * bin_rows)
    plain = {"cut": F.lit(0.0), "sub": F.lit(0).cast("long")}
    if large.isEmpty():
        return placed.withColumns(plain), counted.withColumns(plain)
    large = large.select(F.col("source").alias("s"), F.col("bin").alias("b"),
                         F.ceil(F.col("n") / bin_rows).alias("parts"))
    found = F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))
    cut = F.when(F.col("parts").isNotNull(), F.col("key")).otherwise(0.0)
    sub = F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1)))
    placed = placed.join(large, found, "left").withColumns({"cut": cut, "sub": sub})
    placed = placed.drop("s", "b", "parts")
    sums = placed.groupBy("source", "bin", "cut", "sub").agg(F.sum("size").alias("words"))
    return placed, sums


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    quality: Column | None = None,
    weights: tuple[int, ...] = (5, 2, 1),
    percent: int = 150,
    max_epochs: int = 2,
    seed: str = "mix",
    row_col: str | None = None,
) -> DataFrame:
    """``(id_col, size, source_size, target, taken)`` for every row of ``docs``.

    ``row_col`` (a unique number of each row) comes last, if it is given, and decides ties.

    ``quality`` (a positive column of ``docs``) scales the keys: of two documents one with twice
    the quality comes first twice as often.
    """
    size = word_count(docs[text_col])
    rows = stage(
        docs.select(
            docs[id_col].alias("id"),
            docs[source_col].alias("source"),
            (docs[row_col] if row_col else F.monotonically_increasing_id()).cast("long").alias("row"),
            size.alias("size"),
            (quality if quality is not None else F.lit(1.0)).alias("quality"),
            docs[text_col].alias("text") if quality is None else F.lit(None).alias("text"),
        )
        .withColumn(
            "quality",
            F.col("quality") if quality is not None
            else mean_length_quality(F.col("text"), F.col("size")),
        )
        .drop("text")
        .withColumn("key", -F.ln(uniform(F.coalesce(F.col("id").cast("string"), F.lit("")), seed))
                    / F.col("quality"))
        .drop("quality"),
        "mix",
    )
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows")
    )
    targets = stage(source_targets(sizes, weights, percent, max_epochs), "targets")
    most = targets.agg(F.max("rows")).first()[0] or 0
    placed, sums = binned(rows, most, max(BIN_ROWS, most // MOST_BINS))
    slot = ["source", "bin", "cut", "sub"]
    earlier = Window.partitionBy("source").orderBy(*slot[1:]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    begins = sums.select(*slot, F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("begin"))
    known = begins.join(
        targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    ).select(
        F.col("source").alias("s"), *[F.col(c).alias(f"{c}_") for c in slot[1:]],
        "begin", "source_size", "target",
    )
    inside = Window.partitionBy(*slot).orderBy("key", "id", "size", "row").rowsBetween(
        Window.unboundedPreceding, -1
    )
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    rest = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    room = rest - F.col("begin") - F.col("before")
    return (
        placed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(known, [F.col("source").eqNullSafe(F.col("s")),
                      *[F.col(c) == F.col(f"{c}_") for c in slot[1:]]])
        .withColumn("epochs", epochs)
        .select(
            F.col("id").alias(id_col), "size", "source_size", "target",
            (F.col("epochs") * F.col("size")
             + F.greatest(F.lit(0), F.least(F.col("size"), room))).cast("long").alias("taken"),
            *([F.col("row").alias(row_col)] if row_col else []),
        )
    )


def repeat_taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as taken, the last time maybe only its first words.

    Rows are documents of their own, whatever their ids. ``n_chars``, where there is one, follows
    the text.
    """
    names = docs.columns
    docs, row = numbered(docs, "mixed")
    mixed = mix_sources(docs, id_col, text_col=text_col, row_col=row, **options)
    copies = (
        mixed.where("taken > 0")
        .select(
            F.col(row).alias("__of"),
            F.explode(
                F.transform(
                    F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1),
                    lambda k: F.least(F.col("size"), F.col("taken") - k * F.col("size")),
                )
            ).alias("__words"),
            F.col("size").alias("__size"),
        )
    )
    pieces = F.regexp_extract_all(text_col, F.lit(rf"([\x20\x09-\x0D]*{WORD})"), 1)
    part = F.array_join(F.slice(pieces, F.lit(1), F.col("__words").cast("int")), "")
    text = F.when(F.col("__words") == F.col("__size"), F.col(text_col)).otherwise(part)
    out = docs.join(copies, F.col(row) == F.col("__of")).withColumn(text_col, text)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length(text_col).cast("long"))
    return out.select(*names)
