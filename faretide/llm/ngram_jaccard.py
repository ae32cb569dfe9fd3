"""Size-aware heavy-light join of documents on the Jaccard similarity of word n-grams.

Documents link when ``100 * |A and B| >= percent * |A or B|`` over their sets of n-grams.

1. Documents with the same set form a class; one of each class (the smallest id) goes on.
2. Light (small) sets: every pair of sizes that may link fixes how much they must share, so all
   subsets of that size are enumerated and sets that hold an equal subset are candidates. Up to
   which size this is done is chosen by cost: keys to write against n-grams to shuffle and
   inverted lists to scan.
3. Heavy (large) sets: scan inverted lists of n-grams. First a set's smallest hashes (a little
   more than a link leaves free to differ) are counted over all documents; a set of which too
   few occur elsewhere links with nothing. The others' n-grams are counted in full, and lists are
   kept for each set's rarest n-grams only, enough that linked sets meet in one. N-grams of a
   passage that many documents share thereby stay out of the lists, unless a document consists
   of little else. Two sets are only compared in a list if what comes after its n-gram in both
   is enough for a link.
4. A list is not paired up. Its most central set (fewest n-grams of its own) is compared with the
   others exactly; what links is joined into one component, and lists within one component are
   done. After some rounds, what is left is compared across components only. So no link between
   components is lost, whatever the sizes of lists.

Counts are aggregated before they are shuffled, joins on hot n-grams or classes are split by
adaptive execution, and broadcasts are lists of ids of a checked size. Everything is written to
the shared folder between steps, so that lost executors cost a step at most.

Defined results: NULL, empty and white-space texts have no n-grams, are linked with nothing and
form their own components, as does a NULL id (its component is NULL). Rows that repeat an id are
given once each, with that id's component. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.llm.joins import components, only
from faretide.llm.words import LOWERED, blocks, bounded, constants, lists, mix, shingles
from faretide.session import numbered, stage

#: Sets up to this size are written whole in the first pass, as any of them may be light.
LIGHTEST = 16
#: Times that an n-gram of a heavy set's prefix is written or read on its way into a list.
PASSES = 4
#: Lists are compared pair by pair once that takes at most so many pairs a row,
PAIRS_A_ROW = 2
#: or after so many rounds of comparing with their most central set.
ROUNDS = 3


def _at_least(size, percent):
    """N-grams that a set of this size shares with any set it links with."""
    return -(-percent * size // 100)


def _both_share(n: int, m: int, percent: int) -> int:
    return -(-percent * (n + m) // (100 + percent))


def _slack(size):
    """How many n-grams linked sets share, at least, in what the first pass keeps of them."""
    return np.maximum(1, size // 20)


def _head(size, percent):
    return size - _at_least(size, percent) + _slack(size)


def subset_sizes(n: int, percent: int) -> list[tuple[int, int]]:
    """``(m, k)``: sets of ``n`` and ``m`` n-grams link if they share a subset of ``k``."""
    most = n * 100 // percent
    sizes = [(m, _both_share(n, m, percent)) for m in range(_at_least(n, percent), most + 1)]
    return [(m, k) for m, k in sizes if k <= min(n, m)]


def _first_pass(width: int, percent: int):
    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                values, bounds = shingles(block, width, LOWERED)
                sizes = np.diff(bounds)
                digests = [
                    np.concatenate([[np.uint64(0)], np.cumsum(mix(values * c))])
                    for c in constants(2, 5)
                ]
                keep = np.where(sizes <= LIGHTEST, sizes, _head(sizes, percent))
                ends = np.concatenate([[0], np.cumsum(keep)])
                at = np.arange(ends[-1]) + np.repeat(bounds[:-1] - ends[:-1], keep)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.rows),
                        pa.array(sizes.astype(np.int64)),
                        *(pa.array((d[bounds[1:]] - d[bounds[:-1]]).view(np.int64)) for d in digests),
                        lists(values[at], ends),
                    ],
                    ["id", "n", "d1", "d2", "head"],
                )

    return sketch


def _whole_sets(width: int):
    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                values, bounds = shingles(block, width, LOWERED)
                ids = batch.column(0).slice(block.first, block.rows)
                sizes = pa.array(np.diff(bounds).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids, sizes, lists(values, bounds)], ["id", "n", "items"]
                )

    return sets


def _subset_keys(percent: int):
    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, items in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                items = np.sort(items.values.to_numpy().view(np.uint64))
                for m, k in subset_sizes(len(items), percent):
                    low, high = sorted((len(items), m))
                    chosen = np.array(list(combinations(range(len(items)), k)))
                    total = (items[chosen] * constants(k, 9)).sum(1, dtype=np.uint64)
                    tag = mix(np.array([low << 40 | high << 20 | k], np.uint64))
                    out += [(i, key) for key in mix(total + tag).view(np.int64).tolist()]
            ids, found = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(found, pa.int64())], ["id", "key"]
            )

    return keys


def light_up_to(small: DataFrame, percent: int) -> int:
    """The size up to which enumerating subsets costs less than scanning inverted lists.

    ``small`` has the sets of at most ``LIGHTEST`` n-grams; what comes back is a row a size.
    """
    items = small.select(
        "n", F.explode(F.slice("head", 1, _head_column(F.col("n"), percent))).alias("token")
    )
    lengths = items.groupBy("token").agg(F.count("*").alias("length"))
    scanned = items.join(lengths, "token").groupBy("n").agg(F.sum("length").alias("scanned"))
    sizes = small.groupBy("n").agg(F.count("*").alias("sets")).join(scanned, "n", "left")
    found = {r["n"]: (r["sets"], r["scanned"] or 0) for r in sizes.collect()}
    best, chosen, total = 0, 0, 0
    for n in range(1, LIGHTEST + 1):
        sets, scan = found.get(n, (0, 0))
        keys = sum(comb(n, k) for _, k in subset_sizes(n, percent))
        total += sets * keys - (sets * PASSES * int(_head(np.int64(n), percent)) + scan)
        if total <= best:
            best, chosen = total, n
    return chosen


def _head_column(n: Column, percent: int) -> Column:
    return (n - F.ceil(n * percent / 100) + F.greatest(F.lit(1), F.floor(n / 20))).cast("int")


def _heavy_survivors(heads: DataFrame, percent: int) -> DataFrame:
    """Ids of the sets that share enough of their smallest hashes to link with another."""
    n = F.col("n")
    tokens = heads.select(
        "id", "n", F.explode(F.slice("head", 1, _head_column(n, percent))).alias("token")
    )
    shared = tokens.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1")
    least = F.greatest(F.lit(1), F.floor(F.ceil(n * percent / 100) / 20))
    return (
        tokens.join(shared.select("token"), "token")
        .groupBy("id", "n").agg(F.count("*").alias("hits"))
        .where(F.col("hits") >= least).select("id")
    )


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """Lists ``(key, id, n, lone, pos)`` of each set's rarest n-grams that other sets have too.

    ``pos`` is the n-gram's place in the set when sorted from rare to frequent.
    """
    tokens = sets.select("id", "n", F.explode("items").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    n = F.col("n")
    free = n - F.ceil(n * percent / 100) + 1
    return (
        tokens.join(counts, "token")
        .groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("all"))
        .withColumn("own", n - F.size("all"))
        .where(F.col("own") < free)
        .select(
            "id", "n", "own",
            F.posexplode(F.slice("all", F.lit(1), (free - F.col("own")).cast("int")))
            .alias("at", "t"),
        )
        .select(
            F.col("t.token").alias("key"), "id", "n", (F.col("own") / n).alias("lone"),
            (F.col("own") + F.col("at") + 1).alias("pos"),
        )
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that link, by their whole sets."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    needed = only(sets, ids, "id")
    left = needed.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = needed.select(F.col("id").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", both.alias("both"), (F.size("x") + F.size("y") - both).alias("either"))
        .where(F.col("both") * 100 >= F.col("either") * percent)
        .select("a", "b")
    )


def _close(one: str, two: str, percent: int) -> Column:
    """Whether two sets can share enough if this is the rarest n-gram that both have.

    Linked sets pass in the list of that n-gram, whatever other lists they meet in.
    """
    n, m = F.col(f"{one}n"), F.col(f"{two}n")
    left = F.least(n - F.col(f"{one}pos"), m - F.col(f"{two}pos")) + 1
    return left * (100 + percent) >= (n + m) * percent


def linked(listed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(id, component)`` of the sets that link with another."""
    spark = listed.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "id long, component long")
    active = listed.withColumn("component", F.col("id"))
    for turn in range(ROUNDS + 1):
        hubs = active.groupBy("key").agg(
            F.min(F.struct("lone", "id", "n", "component", "pos")).alias("hub"),
            F.min("component").alias("low"), F.max("component").alias("high"),
        ).where("low <> high").select("key", "hub")
        active = stage(active.join(hubs, "key"), "lists")
        sizes = active.groupBy("key").agg(F.count("*").alias("c"))
        rows, all_pairs = sizes.agg(F.sum("c"), F.sum(F.expr("c * (c - 1) / 2"))).first()
        if not rows:
            break
        last = turn == ROUNDS or all_pairs <= PAIRS_A_ROW * rows
        if not last:
            pairs = active.where(
                (F.col("component") != F.col("hub.component"))
                & _close("", "hub.", percent)
            ).select(F.col("hub.id").alias("a"), F.col("id").alias("b"))
            active = active.where(F.col("id") != F.col("hub.id"))
        else:
            one, two = active.alias("one"), active.alias("two")
            pairs = one.join(
                two,
                (F.col("one.key") == F.col("two.key")) & (F.col("one.id") < F.col("two.id"))
                & (F.col("one.component") != F.col("two.component"))
                & _close("one.", "two.", percent),
            ).select(F.col("one.id").alias("a"), F.col("two.id").alias("b"))
        found = stage(_verified(stage(pairs.distinct(), "pairs"), sets, percent), "links")
        active = active.select("key", "id", "n", "lone", "pos", "component")
        empty = found.isEmpty()
        if not empty:
            links = links.union(found)
            labels = components(links)
        if last:
            break
        if empty:
            continue
        active = (
            active.drop("component").join(labels, "id", "left")
            .withColumn("component", F.coalesce("component", "id"))
            .select("key", "id", "n", "lone", "pos", "component")
        )
    return labels


def ngram_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` for every row of ``docs``."""
    texts = bounded(docs).select(
        docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")
    )
    schema = "id long, n long, d1 long, d2 long, head array<long>"
    sketches = stage(texts.mapInArrow(_first_pass(width, percent), schema), "sketches")
    classes = stage(
        sketches.where("n > 0 AND id IS NOT NULL")
        .groupBy("n", "d1", "d2").agg(F.min("id").alias("first")),
        "classes",
    )
    heads = only(
        sketches.where("n > 0").select("id", "n", "head"),
        classes.select(F.col("first").alias("id")),
        "id",
    )
    small = stage(heads.where(F.col("n") <= LIGHTEST), "small")
    light = light_up_to(small, percent)
    heavy = heads.where(F.col("n") >= _at_least(light + 1, percent))
    survivors = stage(_heavy_survivors(heavy, percent), "survivors")
    wanted = survivors.union(small.where(F.col("n") <= light).select("id")).distinct()
    sets = stage(
        only(texts.where("id IS NOT NULL"), stage(wanted, "wanted"), "id")
        .mapInArrow(_whole_sets(width), "id long, n long, items array<long>"),
        "sets",
    )
    keys = (
        small.where(F.col("n") <= light).select("id", "head")
        .mapInArrow(_subset_keys(percent), "id long, key long")
        .join(small.select("id", "n"), "id")
        .select("key", "id", "n", F.lit(0.0).alias("lone"), F.lit(1).alias("pos"))
    )
    scanned = _rarest(sets.where(F.col("n") >= _at_least(light + 1, percent)), percent)
    labels = linked(stage(scanned.union(keys), "lists"), sets, percent)
    return (
        sketches.select("id", "n", "d1", "d2")
        .join(classes, ["n", "d1", "d2"], "left")
        .join(labels.select(F.col("id").alias("first"), "component"), "first", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "first", "id"))
            .alias("component_id"),
        )
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` but for those linked, at any distance, to a row that comes before.

    Rows are compared as documents of their own, whatever their ids; of a group, the smallest id's
    row stays (NULL ids come last; of equal ids, any one row). Rows without words all stay.
    """
    names = docs.columns
    docs, row = numbered(docs, "rows")
    found = ngram_components(docs, row, text_col, **options).select(row, "component_id")
    found = stage(found, "components")
    groups = found.groupBy("component_id").agg(F.count("*").alias("members")).where("members > 1")
    members = stage(
        found.join(groups.select("component_id"), "component_id")
        .join(docs.select(row, F.col(id_col).alias("__id")), row)
        .select(row, "component_id", F.struct(F.col("__id").isNull(), "__id", row).alias("place")),
        "members",
    )
    first = members.groupBy("component_id").agg(F.min("place").alias("first"))
    gone = members.join(first, "component_id").where(F.col("place") != F.col("first")).select(row)
    return only(docs, stage(gone, "gone"), row, "left_anti").select(*names)
