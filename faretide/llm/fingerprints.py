"""Threshold-scaled sketches of word shingles, in SQL functions only.

A text's sketch keeps every shingle hash in the lowest ``1 / scale`` of the hash space. Whether a
hash is kept depends on it alone, so sketches of parts unite to the sketch of the whole, and the
share of a small text's sketch found in a large one's estimates how much of it the large one
contains, however unequal their lengths.

A fingerprint is text: a hash of the whole word sequence, a colon, and the kept hashes in order,
16 hex digits each. Equal texts have equal fingerprints. Two fingerprints are alike by the share
of the smaller sketch that the other holds; 1 if the word sequences are the same, and 0 if either
sketch is empty otherwise.

Each text is also compared with an edited one, whose last quarter is replaced by the start of the
next document by id. Documents are cut into ranges of ids by quantiles (``RANGE_ROWS`` documents or
more, at most ``MAX_RANGES`` ranges), and the next one is found within the range; only the first
document of each range is looked up for the range before it. Texts are shuffled once.

Defined results: NULL and empty texts have the fingerprint of the empty sequence. A NULL id comes
first, equal ids in the order of their texts. The only document follows itself. Other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 4
RANGE_ROWS = 1500
MAX_RANGES = 4096
SPACE = r"[\x20\x09-\x0D]+"


def sketch(text: Column, width: int = 5, scale: int = SCALE) -> Column:
    """``struct(tag, kept)`` of a text: hash of its words, and kept hashes in order.

    A text with fewer than ``width`` words has one shingle, its whole sequence.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    words = F.filter(F.split(plain, SPACE), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    # Splitting into a struct keeps each step's result from being computed twice.
    steps = F.transform(F.array(hashes), lambda h: F.struct(h.alias("h"), F.xxhash64(h).alias("tag")))
    low = -(1 << 63) + (1 << 64) // scale

    def kept(h: Column) -> Column:
        last = F.greatest(F.lit(1), F.size(h) - (width - 1))
        every = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(h, i, width)))
        return F.array_sort(
            F.array_distinct(F.filter(every, lambda x: (x < F.lit(low)) & (F.size(h) > 0)))
        )

    return F.transform(steps, lambda s: F.struct(s["tag"].alias("tag"), kept(s["h"]).alias("kept")))[0]


def fingerprint(found: Column) -> Column:
    digits = F.transform(found["kept"], lambda x: F.lpad(F.lower(F.hex(x)), 16, "0"))
    return F.concat(F.lpad(F.lower(F.hex(found["tag"])), 16, "0"), F.lit(":"), F.array_join(digits, ""))


def likeness(one: Column, two: Column) -> Column:
    least = F.least(F.size(one["kept"]), F.size(two["kept"]))
    both = F.size(F.array_intersect(one["kept"], two["kept"]))
    return (
        F.when(one["tag"] == two["tag"], 1.0)
        .when(least > 0, both / least)
        .otherwise(0.0)
    )


def _range_of(value: Column, cuts: list) -> Column:
    """How many of the (sorted) cuts are at most the value, by bisection."""
    if not cuts:
        return F.lit(0)
    held = F.array(*[F.lit(c) for c in cuts])
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(cuts)) & (F.try_element_at(held, at + step) <= value), at + step
        ).otherwise(at),
    )
    return F.when(value.isNull(), -1).otherwise(found)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, scale: int = SCALE
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are (see module)."""
    rows = docs.select(
        docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )
    count = rows.count()
    ranges = min(MAX_RANGES, max(1, count // RANGE_ROWS))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("id", shares, 100 * MAX_RANGES)).first()[0] if shares else []
    rows = rows.withColumn("range", _range_of(F.col("id"), sorted(set(cuts or []))))
    # The first document of each range, for the last of the range before: a row a range.
    first = rows.groupBy("range").agg(F.min("id").alias("id"))
    heads = (
        rows.join(F.broadcast(first.withColumnRenamed("id", "i").withColumnRenamed("range", "r")),
                  (F.col("range") == F.col("r")) & F.col("id").eqNullSafe(F.col("i")))
        .groupBy("range").agg(F.min("text").alias("text"))
    )
    in_turn = Window.orderBy("range")
    heads = heads.select(
        F.lag("range").over(in_turn).alias("r"), F.col("text").alias("head"),
        F.max("range").over(Window.partitionBy()).alias("last"),
    ).select(F.coalesce("r", "last").alias("range"), "head")
    order = Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first(), "text")
    length = F.char_length("text")
    moved = F.floor(length / 4).cast("int")
    return (
        rows.withColumn("next", F.lead("text").over(order))
        .join(heads, "range", "left")
        .withColumn("next", F.coalesce("next", "head"))
        .select(
            "id", "text", length.cast("long").alias("n_chars"), "next",
            F.concat(F.substring("text", F.lit(1), length - moved),
                     F.substring("next", F.lit(1), moved)).alias("edited"),
        )
        .select(
            "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
            F.transform(F.array("text", "edited", "next"), lambda t: sketch(t, width, scale)).alias("s"),
        )
        .select(
            F.col("id").alias(id_col), "n_chars", "edited_sha256",
            fingerprint(F.col("s")[0]).alias("fingerprint"),
            fingerprint(F.col("s")[1]).alias("edited_fingerprint"),
            likeness(F.col("s")[0], F.col("s")[1]).alias("near_edited"),
            likeness(F.col("s")[0], F.col("s")[2]).alias("near_next"),
        )
    )
