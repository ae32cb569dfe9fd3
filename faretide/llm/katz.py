"""Katz backoff: log-probabilities of whole texts under a model learned from some of them.

**Model.** A token after a history seen in training has ``d(c) * c / C``: the count of history and
token, discounted by Good-Turing, over the history's count. Another token has the probability of
the same token after the history without its first word, times the history's weight: what the
discounts left, over what the shorter history gives to tokens not seen after the longer one, so
that probabilities of all tokens add up to 1 after any history. Below the single words stands one
unknown word, which has what their discounts left. Discounts are Good-Turing's ``(r + 1) N(r + 1)
/ (r N(r))`` for small counts as long as they differ from the smoothed ones by more than chance
(Gale and Sampson's rule), and ``(1 + 1/r) ** (b + 1)`` from there on, where ``b`` is the slope of
the counts of counts on log scales: every count leaves something, however many copies a text has.
The first token's history is the beginning of a text; an end is predicted after the last word.

**Tables.** Texts are cut into chunks of some million tokens: the distinct words' hashes by
falling frequency, and the tokens as their numbers. The chunks are stored, bucketed by their own
number, and joined without moving them again. For each length of n-gram, a chunk sends its
distinct n-grams, sorted, with their counts in training texts, to the parts of the hash range that
they lie in; n-grams stand there once a chunk, so no word or copied text makes a part large. A
part adds up, answers every chunk in the order it asked, and names one chunk as owner of each
n-gram. Owners send what their n-grams leave and cover to the parts of the histories, which answer
with weights where a chunk needs them. With these answers a chunk evaluates its texts. Counts
cover all texts; chunks and parts grow in number with the input, not in size (a text longer than a
chunk is a chunk of its own). The driver holds counts of counts up to ``FITTED``.

A lost task repeats the same bytes: chunks and answers are read from written tables.

Defined results: a NULL or empty text, or one of white space, is its end alone. A text whose id is
NULL is neither held out nor learned from. Repeated rows are scored, and learned from, each.
Without any training text the unknown word has probability 1, and every score is 0. Ties in
frequency change a chunk's numbering only. Words are told apart by hashes of 64 bits. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.llm.words import LOWERED, blocks, bounded, constants, doc_column, mix
from faretide.session import fresh_path, stage

ORDER = 2
#: Tokens of a chunk, and n-grams that a part is asked for.
CHUNK, PART = 1 << 21, 1 << 20
#: Counts of counts that discounts are fitted to.
FITTED = 256
FOLDS, HELD = 7, 2

BEGIN, END = (np.uint64(v) for v in mix(np.array([101, 102], np.uint64)))
_LEFT, _RIGHT = constants(2, 31)

_CHUNKS = (
    "chunk long, ids array<{kind}>, learn array<boolean>, sizes array<int>, n_tokens long, "
    "n_words long, words binary, tokens binary"
)
_ASKED = "level int, part long, chunk long, keys binary, counts binary"
_ANSWERS = (
    "level int, part long, chunk long, counts binary, owned binary, "
    "found_r array<long>, found_n array<long>"
)
_SHARES = "part long, chunk long, keys binary, left binary, covered binary, wanted binary"
_WEIGHTS = "level int, part long, chunk long, weights binary"
_ARROW = {
    "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())
}


def pack(values: np.ndarray) -> bytes:
    """An array, compressed byte by byte of its numbers: high bytes are mostly equal."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    head = np.array([len(values)], np.int64).tobytes()
    return head + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(data: bytes, kind: type) -> np.ndarray:
    count, width = int(np.frombuffer(data[:8], np.int64)[0]), np.dtype(kind).itemsize
    raw = pa.decompress(data[8:], count * width, "zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(width, count)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes, as the steps from one to the next."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def _slices(keys: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """Parts of the hash range that sorted keys lie in, and which keys those are."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    edges = np.flatnonzero(np.diff(part)) + 1
    bounds = [0, *edges.tolist(), len(keys)] if len(keys) else [0]
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        yield int(part[low]), slice(low, high)


# --- discounts -------------------------------------------------------------------------


@dataclass(frozen=True)
class Discounts:
    """The share of a count that is kept: ``first`` of the smallest, then by ``slope``."""

    first: tuple[float, ...]
    slope: float

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        counts = np.maximum(counts, 1)
        out = (1 + 1 / counts) ** (self.slope + 1)
        small = counts <= len(self.first)
        out[small] = np.array(self.first)[counts[small] - 1]
        return out


def fit_discounts(found: dict[int, int]) -> Discounts:
    """Discounts for counts of counts: ``found[r]`` n-grams occur r times."""
    sizes = sorted(r for r, n in found.items() if n)
    slope = -2.0
    if len(sizes) > 1:
        around = [0, *sizes, 2 * sizes[-1] - sizes[-2]]
        gaps = np.array([(after - before) / 2 for before, after in zip(around, around[2:], strict=False)])
        x = np.log(sizes)
        y = np.log(np.array([found[r] for r in sizes]) / gaps)
        slope = float(np.polyfit(x, y, 1)[0])
    slope = min(max(slope, -3.0), -1.1)
    first = []
    for r in range(1, FITTED):
        n, following = found.get(r, 0), found.get(r + 1, 0)
        if not n or not following:
            break
        raw = (r + 1) * following / n
        smooth = r * (1 + 1 / r) ** (slope + 1)
        chance = (r + 1) * math.sqrt(following / n**2 * (1 + following / n))
        if abs(raw - smooth) <= 1.65 * chance or raw >= r:
            break
        first.append(raw / r)
    return Discounts(tuple(first), slope)


# --- chunks ----------------------------------------------------------------------------


def store_chunks(docs: DataFrame, chunk: int) -> DataFrame:
    """Chunks of ``(id, text, learn)`` rows, bucketed by their number."""
    kind = docs.schema[0].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, learn, sizes, held = [], [], [], []

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            words, inverse, counts = np.unique(tokens, return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            one = [
                [number], [pa.concat_arrays(ids)], [pa.concat_arrays(learn)],
                [np.concatenate(sizes).astype(np.int32)], [len(tokens)], [len(words)],
                [pack(words[order])], [pack(rank[inverse])],
            ]
            lists = [pa.LargeListArray.from_arrays([0, len(v[0])], v[0]) for v in one[1:3]]
            columns = [pa.array(one[0]), *lists, *map(pa.array, one[3:])]
            names = ["chunk", "ids", "learn", "sizes", "n_tokens", "n_words", "words", "tokens"]
            columns[1:3] = [c.cast(pa.list_(c.type.value_type)) for c in lists]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for block in blocks(doc_column(batch, "__text")):
                start, end, first = block.spans()
                hashes = block.hashes(block.sums(LOWERED), start, end)
                held.append(np.insert(hashes, first[1:], END))
                sizes.append(np.diff(first) + 1)
                ids.append(batch.column(0).slice(block.first, block.rows))
                learn.append(batch.column(2).slice(block.first, block.rows))
                if sum(map(len, held)) >= chunk:
                    yield flush()
                    number += 1
                    ids, learn, sizes, held = [], [], [], []
        if held:
            yield flush()

    chunks = docs.mapInArrow(cut, _CHUNKS.format(kind=kind))
    spark = docs.sparkSession
    buckets = max(docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"faretide_chunks_{uuid.uuid4().hex}"
    path = fresh_path(spark, "chunks")
    chunks.write.bucketBy(min(buckets, 50_000), "chunk").option("path", path).saveAsTable(name)
    stored = spark.table(name)
    stored.schema  # noqa: B018  resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return stored


@dataclass
class Grams:
    """The distinct n-grams of one length in a chunk.

    ``at`` has each token's n-gram (-1 where the text has no such history), ``history`` each
    n-gram's history as a number of the length below, ``sample`` a token that ends it.
    """

    at: np.ndarray
    keys: np.ndarray
    history: np.ndarray
    sample: np.ndarray
    order: np.ndarray


class Chunk:
    """A chunk's tokens and n-grams."""

    def __init__(self, row: dict, order: int):
        self.number = row["chunk"]
        self.sizes = np.array(row["sizes"], np.int64)
        self.ids, self.learn = row["ids"], np.array(row["learn"], bool)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.words = unpack(row["words"], np.uint64)
        self.tokens = unpack(row["tokens"], np.uint32).astype(np.int64)
        self.learned = np.repeat(self.learn, self.sizes)
        order_of = np.argsort(self.words)
        levels = [Grams(self.tokens, self.words, np.zeros(0, np.int64), np.zeros(0, np.int64), order_of)]
        for level in range(2, order + 1):
            levels.append(self._longer(levels[-1], level))
        self.levels = levels

    def _longer(self, below: Grams, level: int) -> Grams:
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = below.at[:-1]
        # Histories of one word: the beginning of a text has the number after the last word.
        before[self.starts] = len(below.keys) if level == 2 else -1
        valid = np.flatnonzero(before >= 0)
        pairs = before[valid] * len(self.words) + self.tokens[valid]
        pairs, sample, inverse = np.unique(pairs, return_index=True, return_inverse=True)
        at = np.full(len(self.tokens), -1)
        at[valid] = inverse
        history, word = np.divmod(pairs, len(self.words))
        keys = mix(self.history_keys(below, level)[history] * _LEFT + self.words[word] * _RIGHT)
        return Grams(at, keys, history, valid[sample], np.argsort(keys))

    def history_keys(self, below: Grams, level: int) -> np.ndarray:
        return np.append(below.keys, BEGIN) if level == 2 else below.keys

    def learned_counts(self, grams: Grams) -> np.ndarray:
        at = grams.at[self.learned]
        return np.bincount(at[at >= 0], minlength=len(grams.keys))


def _rows(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    for k in range(table.num_rows):
        yield {name: table.column(name)[k].as_py() for name in table.schema.names}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    """Rows of a table whose columns are named and typed by ``ddl``."""
    fields = [part.split(" ") for part in ddl.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    arrays = [pa.array(list(c), _ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


# --- counts ----------------------------------------------------------------------------


def ask_counts(chunks: DataFrame, parts: dict[int, int]) -> DataFrame:
    """Every chunk's n-grams of all lengths, by the part of the hash range they lie in."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                chunk = Chunk(row, len(parts))
                for level, grams in enumerate(chunk.levels, 1):
                    keys = grams.keys[grams.order]
                    counts = chunk.learned_counts(grams)[grams.order].astype(np.uint32)
                    yield _batch(
                        [(level, part, chunk.number, pack_keys(keys[s]), pack(counts[s]))
                         for part, s in _slices(keys, parts[level])], _ASKED
                    )

    return chunks.mapInArrow(ask, _ASKED)


def answer_counts(asked: pa.Table) -> pa.Table:
    """Counts over all chunks of a part's n-grams, in the order that each chunk asked."""
    rows = sorted(_rows(asked), key=lambda row: row["chunk"])
    keys = [unpack_keys(row["keys"]) for row in rows]
    unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total, seen = np.zeros(len(unique), np.int64), np.zeros(len(unique), bool)
    places = np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])
    counts = [unpack(row["counts"], np.uint32).astype(np.int64) for row in rows]
    for place, count in zip(places, counts, strict=True):
        total[place] += count
    r, n = np.unique(total[total > 0], return_counts=True)
    found = r.tolist(), n.tolist()
    out = []
    for row, place, count in zip(rows, places, counts, strict=True):
        owned = (count > 0) & ~seen[place]
        seen[place[owned]] = True
        out.append((row["level"], row["part"], row["chunk"], pack(total[place]),
                    pack(np.packbits(owned)), *(found if not out else ([], []))))
    return pa.Table.from_batches([_batch(out, _ANSWERS)])


def read_answers(answers: pa.Table, chunk: Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length, the counts of the chunk's n-grams and whether it owns them."""
    rows = sorted(_rows(answers), key=lambda row: (row["level"], row["part"]))
    out = []
    for level, grams in enumerate(chunk.levels, 1):
        counts, owned = np.zeros(len(grams.keys), np.int64), np.zeros(len(grams.keys), bool)
        at = 0
        for row in rows:
            if row["level"] == level and row["counts"] is not None:
                values = unpack(row["counts"], np.int64)
                to = grams.order[at : at + len(values)]
                counts[to] = values
                owned[to] = np.unpackbits(unpack(row["owned"], np.uint8), count=len(values))
                at += len(values)
        if at != len(grams.keys):
            raise RuntimeError(f"chunk {chunk.number}: {at} answers for {len(grams.keys)} n-grams")
        out.append((counts, owned))
    return out


# --- evaluation ------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """What every chunk needs to know of all: totals, discounts, and the unknown word's share."""

    tokens: int
    types: int
    unknown: float
    discounts: tuple[Discounts, ...]


class Evaluation:
    """Natural logarithms of probabilities, from single words up."""

    def __init__(self, chunk: Chunk, model: Model, answers: pa.Table):
        self.chunk, self.model = chunk, model
        self.answers = read_answers(answers, chunk)
        self.asked = [row for row in _rows(answers) if row["weights"] is not None]

    def history_counts(self, level: int) -> np.ndarray:
        """How often training texts go on after each history of the n-grams of ``level``."""
        counts = self.answers[level - 2][0]
        if level > 2:
            return counts
        end = counts[np.flatnonzero(self.chunk.words == END)]
        return np.append(counts, end if len(end) else 0)

    def needed(self, level: int) -> np.ndarray:
        """Known histories of n-grams that training texts do not have, in order of their keys."""
        grams, counts = self.chunk.levels[level - 1], self.answers[level - 1][0]
        wanted = np.zeros(len(self.history_counts(level)), bool)
        wanted[grams.history[counts == 0]] = True
        wanted &= self.history_counts(level) > 0
        return wanted

    def weights(self, level: int) -> np.ndarray:
        """Logarithms of the weights of histories; 0 where a history was not seen."""
        below = self.chunk.levels[level - 2]
        keys = self.chunk.history_keys(below, level)
        wanted = np.flatnonzero(self.needed(level))
        wanted = wanted[np.argsort(keys[wanted])]
        rows = sorted((r for r in self.asked if r["level"] == level), key=lambda r: r["part"])
        values = [unpack(row["weights"], np.float64) for row in rows]
        values = np.concatenate([*values, np.zeros(0)])
        if len(values) != len(wanted):
            raise RuntimeError(f"{len(values)} weights for {len(wanted)} histories")
        out = np.zeros(len(keys))
        out[wanted] = np.log(values / self.history_counts(level)[wanted])
        return out

    def tokens(self, level: int) -> np.ndarray:
        """For each token its logarithm with histories of up to ``level`` - 1 words."""
        model, counts = self.model, self.answers[level - 1][0]
        kept = model.discounts[level - 1](counts) * counts
        with np.errstate(divide="ignore"):
            if level == 1:
                seen = np.log(kept / max(model.tokens, 1))
                return np.where(counts > 0, seen, math.log(model.unknown))[self.chunk.tokens]
            grams, out = self.chunk.levels[level - 1], self.tokens(level - 1)
            seen = np.log(kept / np.maximum(self.history_counts(level)[grams.history], 1))
        weight = self.weights(level)[grams.history]
        valid = grams.at >= 0
        at = grams.at[valid]
        out[valid] = np.where(counts[at] > 0, seen[at], weight[at] + out[valid])
        return out


def ask_weights(joined, model: Model, level: int, parts: int, order: int) -> DataFrame:
    """What owners' n-grams leave and cover, and the histories whose weight a chunk needs."""

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in _rows(left):
            chunk = Chunk(row, order)
            found = Evaluation(chunk, model, right)
            grams, (counts, owned) = chunk.levels[level - 1], found.answers[level - 1]
            below = np.exp(found.tokens(level - 1)[grams.sample])
            keep = model.discounts[level - 1](counts)
            keys = chunk.history_keys(chunk.levels[level - 2], level)
            own = grams.history[owned]
            left_over = np.bincount(own, ((1 - keep) * counts)[owned], len(keys))
            covered = np.bincount(own, below[owned], len(keys))
            wanted = found.needed(level)
            send = wanted.copy()
            send[own] = True
            send = np.flatnonzero(send)
            send = send[np.argsort(keys[send])]
            for part, s in _slices(keys[send], parts):
                to = send[s]
                out.append((part, chunk.number, pack_keys(keys[to]), pack(left_over[to]),
                            pack(covered[to]), pack(np.packbits(wanted[to]))))
        return pa.Table.from_batches([_batch(out, _SHARES)])

    return joined.applyInArrow(ask, _SHARES)


def answer_weights(level: int):
    """What each history's n-grams leave, over what they do not cover of the level below."""

    def answer(asked: pa.Table) -> pa.Table:
        rows = sorted(_rows(asked), key=lambda row: row["chunk"])
        keys = [unpack_keys(row["keys"]) for row in rows]
        unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        left, covered = np.zeros(len(unique)), np.zeros(len(unique))
        places = np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])
        for row, place in zip(rows, places, strict=True):
            left[place] += unpack(row["left"], np.float64)
            covered[place] += unpack(row["covered"], np.float64)
        weight = left / np.maximum(1 - covered, np.finfo(float).eps)
        out = []
        for row, place in zip(rows, places, strict=True):
            wanted = np.unpackbits(unpack(row["wanted"], np.uint8), count=len(place)).astype(bool)
            if wanted.any():
                out.append((level, row["part"], row["chunk"], pack(weight[place[wanted]])))
        return pa.Table.from_batches([_batch(out, _WEIGHTS)])

    return answer


def _found(answers: DataFrame, level: int) -> tuple[Discounts, int, int, float]:
    """Discounts of a length, its tokens and types in training, and what the discounts leave."""
    pairs = answers.where(F.col("level") == level).select(
        F.explode(F.arrays_zip(F.col("found_r").alias("r"), F.col("found_n").alias("n"))).alias("f")
    ).select("f.r", "f.n")
    each = stage(pairs.groupBy("r").agg(F.sum("n").alias("n")), "counts")
    discounts = fit_discounts({r["r"]: r["n"] for r in each.where(F.col("r") <= FITTED).collect()})
    kept = F.pow(1 + 1 / F.col("r"), F.lit(discounts.slope + 1))
    for r, share in enumerate(discounts.first, 1):
        kept = F.when(F.col("r") == r, F.lit(share)).otherwise(kept)
    total = each.agg(
        F.sum(F.col("r") * F.col("n")).alias("tokens"), F.sum("n").alias("types"),
        F.sum((1 - kept) * F.col("r") * F.col("n")).alias("left"),
    ).first()
    return discounts, total["tokens"] or 0, total["types"] or 0, total["left"] or 0.0


def score_texts(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    chunk: int = CHUNK,
    part: int = PART,
) -> DataFrame:
    """Every text's score under a model of the rows where ``learn`` is true, and a base score.

    The base is the sum of ``log10((c + 1) / (N + V + 1))`` over single tokens.
    """
    rows = docs.select(docs[id_col], docs[text_col].alias("__text"),
                       F.coalesce(learn, F.lit(False)).alias("__learn"))
    chunks = store_chunks(bounded(rows), chunk)
    sizes = chunks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    asked = {1: sizes["words"] or 0} | dict.fromkeys(range(2, order + 1), sizes["tokens"] or 0)
    parts = {level: -(-count // part) or 1 for level, count in asked.items()}
    asked = ask_counts(chunks, parts).groupBy("level", "part")
    answers = stage(asked.applyInArrow(answer_counts, _ANSWERS), "answers")
    found = [_found(answers, level) for level in range(1, order + 1)]
    _, tokens, types, left = found[0]
    model = Model(tokens, types, left / tokens if tokens else 1.0, tuple(f[0] for f in found))
    known = answers.drop("found_r", "found_n").withColumn("weights", F.lit(None).cast("binary"))

    def joined():
        return chunks.groupBy("chunk").cogroup(known.groupBy("chunk"))

    for level in range(2, order + 1):
        asked = ask_weights(joined(), model, level, parts[level - 1], order)
        weights = stage(asked.groupBy("part").applyInArrow(answer_weights(level), _WEIGHTS), "weights")
        known = known.unionByName(weights, allowMissingColumns=True)
    kind = rows.schema[0].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double"
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for k, row in enumerate(_rows(left.drop_columns(["ids"]))):
            part = Chunk(row | {"ids": left.column("ids")}, order)
            found = Evaluation(part, model, right)
            counts = found.answers[0][0]
            base = np.log10((counts + 1) / (model.tokens + model.types + 1))[part.tokens]
            logs = found.tokens(order) / math.log(10)
            out.append(pa.RecordBatch.from_arrays(
                [
                    left.column("ids").combine_chunks()[k].values, pa.array(part.sizes),
                    pa.array(np.add.reduceat((counts > 0)[part.tokens].astype(np.int64), part.starts)),
                    pa.array(np.full(len(part.sizes), model.tokens)),
                    pa.array(np.add.reduceat(base, part.starts)),
                    pa.array(np.add.reduceat(logs, part.starts)),
                ],
                [id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            ))
        return pa.Table.from_batches(out)

    return joined().applyInArrow(score, schema)


def score_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """:func:`score_texts`, learned from the folds other than ``HELD`` of the ids' CRC-32."""
    fold = lambda column: F.crc32(column.cast("string").cast("binary")) % FOLDS
    scored = score_texts(docs, fold(docs[id_col]) != HELD, id_col, text_col, **options)
    held = F.coalesce(fold(F.col(id_col)) == HELD, F.lit(False)).alias("held_out")
    return scored.select(id_col, held, "n_tokens", "n_known", "train_tokens", "base_score", "score")
