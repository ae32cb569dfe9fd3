"""A quality classifier without labels: heuristic labellers, their accuracies, a linear scorer.

1. Labellers look at a whole text and vote good or bad, or abstain.
2. Expectation-maximisation finds how often good texts exist and how often each labeller votes
   which way on good and bad ones, from the votes of all documents. Patterns of votes are counted
   in Spark; the driver sees a row a pattern, of which there are ``3 ** labellers`` at most.
3. Posterior labels of a bounded sample (at most about ``sample`` different texts, by a hash of the
   text, each weighed by its copies) train a logistic regression on hashed features (shapes, last bytes and last letter pairs of words, as
   shares of the text's words) and on steps of the text's variety.
4. The scorer's weights, ``COLUMNS`` numbers, travel with the job and score every whole text.

A text's variety is the lowest share of distinct words in any of its windows: ``WINDOW`` words that
follow each other, the last window ending with the text, or the whole of a shorter text. So it
does not sink with a text's length alone.

Nothing is shuffled but pattern counts, the sample's texts and gradient sums.

Defined results: NULL and empty texts, and texts of white space, abstain everywhere, have no
features and are kept with the scorer's prior. If the sample holds no two different labels, the
posterior is the score. Repeated rows are scored each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretide.llm.words import Block, blocks, bounded, constants, mix
from faretide.session import stage

FEATURES = 512
#: A text's variety is a feature by how many of these it stays below.
STEPS = np.array([0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5])
COLUMNS = FEATURES + len(STEPS)
WINDOW = 200
LOW_VARIETY = 0.15
SAMPLE = 20_000
ROUNDS = 100
#: Classes of bytes: fixed values of this module.
LOWER, UPPER, DIGIT, MARK, SYMBOL = 1, 2, 3, 4, 5
KINDS = np.full(256, LOWER, np.uint8)
KINDS[ord("A") : ord("Z") + 1] = UPPER
KINDS[ord("0") : ord("9") + 1] = DIGIT
KINDS[[ord(c) for c in ".,;:!?'\"()-"]] = MARK
KINDS[[ord(c) for c in "#*$%&|<>@^~=+_[]{}\\/`"]] = SYMBOL
KINDS[[9, 10, 11, 12, 13, 32]] = 0

#: Each but the last knows one kind of bad text and otherwise abstains.
LABELLERS = ("symbols", "tails", "bars", "capitals", "bangs", "variety", "repeats", "prose")


def _variety(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each text's lowest share of distinct words in a window; 1 for texts without words."""
    counts = np.diff(first)
    several = -(-counts // WINDOW)
    rows = np.repeat(np.arange(len(counts)), several)
    out = np.ones(len(counts))
    if not len(rows):
        return out
    begins = np.cumsum(several) - several
    step = np.arange(len(rows)) - np.repeat(begins, several)
    start = first[:-1][rows] + np.minimum(step * WINDOW, np.maximum(counts[rows] - WINDOW, 0))
    sizes = np.minimum(counts[rows], WINDOW)
    of = np.repeat(np.arange(len(rows)), sizes)
    at = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + start[of]
    own = mix(words[at] + constants(1, 17)[0] * (of.astype(np.uint64) + np.uint64(1)))
    _, index = np.unique(own, return_index=True)
    share = np.bincount(of[index], minlength=len(rows)) / sizes
    np.minimum.at(out, rows, share)
    return out


def _votes(block: Block) -> np.ndarray:
    """A column a labeller: 1 good, -1 bad, 0 no vote."""
    start, end, first = block.spans()
    counts = np.diff(first)
    n = np.maximum(counts, 1)
    kinds = KINDS[block.data]

    def total(flags, at=block.offsets):
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[at[1:]] - sums[at[:-1]]

    last = block.data[end - 1] if len(end) else block.data[:0]
    symbols = total(kinds == SYMBOL) / n
    upper = total(kinds == UPPER) / np.maximum(total((kinds == UPPER) | (kinds == LOWER)), 1)
    bangs = total((last == ord("!")) | (last == ord("?")), first) / n
    words = block.hashes(block.sums(), start, end)
    rows = np.repeat(np.arange(block.rows), counts)
    own = mix(words + constants(1, 17)[0] * (rows.astype(np.uint64) + np.uint64(1)))
    variety = _variety(words, first)
    same = np.concatenate([[False], own[1:] == own[:-1]]) if len(own) else own.astype(bool)
    repeats = total(same, first) / n
    stops = total(last == ord("."), first)
    bars = total((end - start == 1) & (kinds[start] == SYMBOL), first) / n
    tails = total(kinds[end - 1] == SYMBOL, first) / n
    prose = (symbols < 0.02) & (upper < 0.3) & (bangs < 0.05) & (stops > 0) & (repeats < 0.05)
    prose &= variety >= 2 * LOW_VARIETY
    bad = lambda flags: -1 * (flags & (counts > 0))
    return np.stack(
        [
            bad(symbols > 0.1),
            bad(tails > 0.1),
            bad(bars > 0.1),
            bad(upper > 0.5),
            bad(bangs > 0.2),
            bad(variety < LOW_VARIETY),
            bad(repeats > 0.2),
            np.where(prose, 1, 0),
        ],
        axis=1,
    ).astype(np.int8)


def _features(block: Block) -> np.ndarray:
    """A row a text: shares of its words with each hashed feature, and steps of its variety."""
    start, end, first = block.spans()
    counts = np.diff(first)
    if not len(start):
        return np.zeros((block.rows, COLUMNS), np.float32)
    rows = np.repeat(np.arange(block.rows), counts)
    kinds = KINDS[block.data].astype(np.uint64)
    lead, tail = kinds[start], kinds[end - 1]
    inner = kinds[np.maximum(end - 2, start)]
    middle = kinds[(start + end) // 2]
    size = np.minimum(end - start, 15).astype(np.uint64) // np.uint64(3)
    again = np.zeros(len(start), np.uint64)
    words = block.hashes(block.sums(), start, end)
    again[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    out = np.zeros(block.rows * FEATURES)
    for seed, code in enumerate(
        (
            ((lead * np.uint64(8) + middle) * np.uint64(8) + inner) * np.uint64(8) + tail,
            block.data[end - 1].astype(np.uint64),
            size * np.uint64(2) + again,
            block.data[np.maximum(end - 2, start)].astype(np.uint64) * np.uint64(256)
            + block.data[end - 1],
        )
    ):
        slot = mix(code + constants(4, 19)[seed]) % np.uint64(FEATURES)
        out += np.bincount(rows * FEATURES + slot.astype(np.int64), minlength=len(out))
    # As if every text had ten words more without features, so that few words say little.
    out = out.reshape(block.rows, FEATURES) / (counts + 10)[:, None]
    low = _variety(words, first)[:, None] < STEPS
    return np.concatenate([np.sqrt(out), low], axis=1).astype(np.float32)


def _patterns(docs: DataFrame, id_name: str) -> DataFrame:
    """Each text's votes as text, such as ``+0-+``."""

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = np.array(["-", "0", "+"])
        for batch in batches:
            for block in blocks(batch.column(1)):
                names = ["".join(x) for x in signs[_votes(block) + 1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.rows), pa.array(names, pa.string())],
                    [id_name, "votes"],
                )

    kind = docs.schema[0].dataType.simpleString()
    return bounded(docs).mapInArrow(vote, f"`{id_name}` {kind}, votes string")


def fit_labellers(patterns: dict[str, int], rounds: int = ROUNDS) -> tuple[dict[str, float], dict]:
    """Posterior of good for each pattern of votes, and what was estimated.

    Labellers are independent given the class. They start as mostly right, and each keeps a few
    counts' worth of that belief, so that the classes cannot change places.
    """
    names = sorted(patterns)
    if not names:
        return {}, {"good": 1.0, "accuracy": {}}
    votes = np.array([["-0+".index(c) for c in name] for name in names])
    weight = np.array([patterns[name] for name in names], float)
    prior = np.array([[0.3, 0.65, 0.05], [0.01, 0.59, 0.4]])
    belief = np.repeat(prior[:, None], votes.shape[1], 1)
    good = 0.9
    for _ in range(rounds):
        log = np.log(belief)[:, np.arange(votes.shape[1]), votes].sum(2)
        log += np.log([1 - good, good])[:, None]
        log -= log.max(0)
        share = np.exp(log)
        share /= share.sum(0)
        for c in (0, 1):
            for k in range(votes.shape[1]):
                seen = np.bincount(votes[:, k], weight * share[c], 3)
                # Belief worth 1 % of all documents, that a rare class is not fitted to noise.
                seen += prior[c] * (1 + 0.01 * weight.sum())
                belief[c, k] = seen / seen.sum()
        good = float(np.clip((weight * share[1]).sum() / weight.sum(), 0.5, 0.999))
    accuracy = {
        name: float(
            ((1 - good) * belief[0, k, 0] + good * belief[1, k, 2])
            / ((1 - good) * (1 - belief[0, k, 1]) + good * (1 - belief[1, k, 1]))
        )
        for k, name in enumerate(LABELLERS)
    }
    return dict(zip(names, share[1].tolist(), strict=True)), {"good": good, "accuracy": accuracy}


class Scorer:
    """Posteriors of vote patterns, and the linear scorer trained on them."""

    def __init__(self, posterior: dict[str, float], info: dict, weights: np.ndarray, bias: float):
        self.posterior, self.info, self.weights, self.bias = posterior, info, weights, bias

    def score(self, block: Block) -> np.ndarray:
        return 1 / (1 + np.exp(-(_features(block) @ self.weights + self.bias)))


def sampled(docs: DataFrame, sample: int, text_col: str = "text", rows: int | None = None) -> DataFrame:
    """``(copies, text)`` of about ``sample`` rows' different texts at most, spread by their hash.

    A text is one row however many copies it has, which it counts for.
    """
    share = min(1.0, sample / max(1, docs.count() if rows is None else rows))
    text = docs[text_col]
    chosen = docs.select(F.xxhash64(text).alias("h"), text.alias("text")).where(
        (F.pmod("h", F.lit(1 << 31)) < int(share * (1 << 31))) & F.col("text").isNotNull()
    )
    chosen = chosen.groupBy("h").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    return bounded(chosen).select("copies", "text")


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Scorer:
    """Estimate labellers over all rows of ``docs`` and fit the scorer on about ``sample``."""
    texts = docs.select(F.xxhash64(docs[text_col]).alias("h"), docs[text_col].alias("text"))
    counts = _patterns(texts, "h").groupBy("votes").count().collect()
    found = {row["votes"]: row["count"] for row in counts}
    posterior, info = fit_labellers(found)
    chosen = sampled(docs, sample, text_col, sum(found.values()))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = np.array(["-", "0", "+"])
        for batch in batches:
            for block in blocks(batch.column(1)):
                label = [posterior["".join(x)] for x in signs[_votes(block) + 1]]
                values = _features(block)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.rows),
                        pa.array(label, pa.float64()),
                        pa.ListArray.from_arrays(
                            np.arange(block.rows + 1, dtype=np.int32) * COLUMNS,
                            pa.array(values.ravel()),
                        ),
                    ],
                    ["copies", "good", "values"],
                )

    # Each pass of the fit reads it; a stored copy survives the executors.
    soft = stage(chosen.mapInArrow(rows, "copies long, good double, values array<float>"), "soft")
    part = F.explode(
        F.array(
            F.struct(F.lit(1.0).alias("label"), F.col("good").alias("share")),
            F.struct(F.lit(0.0).alias("label"), (1 - F.col("good")).alias("share")),
        )
    )
    soft = soft.select(array_to_vector("values").alias("features"), "copies", part.alias("part"))
    soft = soft.where("part.share > 1e-6").select(
        "features", "part.label", (F.col("part.share") * F.col("copies")).alias("weight")
    )
    if soft.select("label").distinct().count() < 2:
        return Scorer(posterior, info, np.zeros(COLUMNS, np.float32), 6.0)
    model = LogisticRegression(
        maxIter=30, regParam=1e-4, weightCol="weight", standardization=False
    ).fit(soft)
    weights = model.coefficients.toArray().astype(np.float32)
    return Scorer(posterior, info, weights, float(model.intercept))


def classify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    scorer: Scorer | None = None,
    least: float = 0.5,
) -> DataFrame:
    """``(id_col, votes, posterior, score, kept)`` for every row."""
    scorer = scorer or train(docs, text_col)
    texts = bounded(docs).select(docs[id_col], docs[text_col].alias("__text"))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = np.array(["-", "0", "+"])
        for batch in batches:
            for block in blocks(batch.column(1)):
                votes = ["".join(x) for x in signs[_votes(block) + 1]]
                found = scorer.score(block).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.rows), pa.array(votes, pa.string()),
                     pa.array([scorer.posterior.get(v) for v in votes], pa.float64()),
                     pa.array(found), pa.array(found >= least)],
                    [id_col, "votes", "posterior", "score", "kept"],
                )

    kind = texts.schema[0].dataType.simpleString()
    return texts.mapInArrow(
        score, f"`{id_col}` {kind}, votes string, posterior double, score double, kept boolean"
    )


def keep_good(
    docs: DataFrame, text_col: str = "text", scorer: Scorer | None = None, least: float = 0.5
) -> DataFrame:
    """The rows whose text the scorer takes for good, with all their columns."""
    scorer, at = scorer or train(docs, text_col), docs.columns.index(text_col)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [scorer.score(b) >= least for b in blocks(batch.column(at))]
            if verdicts:
                yield batch.filter(pa.array(np.concatenate(verdicts)))

    return bounded(docs).mapInArrow(keep, docs.schema)
