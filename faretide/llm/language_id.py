"""Language identification by rank-order profiles of letter n-grams.

A profile ranks n-grams of one to three letters by frequency, with a mark for a word's edge, and
keeps the first ``size``. A language's profile is counted over all its training texts. A text gets
the language whose profile is nearest to its own by out-of-place distance: the difference in rank
for n-grams in both, ``size`` for the others. The score is 1 less the distance as a share of the
largest possible.

Counting sums up n-grams within each task before anything is shuffled, by language and n-gram, so
a language with any share of the rows is spread over its n-grams. Profiles (languages times
``size`` numbers, languages checked: 48 MB at most) are broadcast; prediction shuffles nothing.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0, as is every text
when nothing was learned. A NULL id is neither held out nor learned from. Of languages at equal
distance the first by name is taken. Repeated rows are predicted each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faretide.llm.words import bounded, constants, mix

SIZE = 300
MAX_LANGUAGES = 10_000
#: Characters taken at a time, and different n-grams summed up before they are passed on.
CHARS, GRAMS = 1 << 19, 1 << 20
#: Texts times languages whose distances are held at a time.
CELLS = 1 << 20


def _parts(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Texts, lower-cased, in runs of about ``CHARS`` characters, with the first one's number."""
    first, size, run = 0, 0, []
    for k, text in enumerate(texts):
        run.append((text or "").lower())
        size += len(run[-1])
        if size >= CHARS or len(run) >= 8000:
            yield first, run
            first, size, run = k + 1, 0, []
    if run:
        yield first, run


def _letters(run: list[str]):
    """Letters of all texts as small numbers with 0 at edges of words; their text; the alphabet."""
    codes = np.frombuffer("\n".join(["", *run, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    present = np.flatnonzero(np.bincount(np.minimum(codes, 0x10000), minlength=1))
    if present[-1] == 0x10000:
        present = np.union1d(present[:-1], codes[codes >= 0x10000])
    alphabet = np.array([c for c in present if chr(c).isalpha()], np.uint32)
    table = np.zeros(int(present[-1]) + 1, np.uint32)
    table[alphabet] = np.arange(1, len(alphabet) + 1)
    symbols = table[codes]
    keep = symbols > 0
    keep[1:] |= symbols[:-1] > 0
    keep[0] = True
    ends = np.cumsum([len(t) + 1 for t in run])
    at = np.flatnonzero(keep)
    rows = np.searchsorted(ends, at - 1, "right")
    return symbols[at].astype(np.uint64), np.minimum(rows, len(run) - 1), alphabet


def _counted(run: list[str], groups: np.ndarray | None = None):
    """N-grams by text (or by its group): group, n-gram's hash, number; in order of texts.

    An n-gram and its text are packed into 64 bits. A run with so many texts and letters that they
    do not fit is counted in halves; a single text always fits.
    """
    symbols, rows, alphabet = _letters(run)
    bits = np.uint64(max(1, int(len(alphabet)).bit_length()))
    first = rows.copy()
    first[:-1][symbols[:-1] == 0] = rows[1:][symbols[:-1] == 0]
    numbers, of = np.unique(first if groups is None else groups[first], return_inverse=True)
    if 3 * int(bits) + 2 + (len(numbers) - 1).bit_length() > 64:
        half = len(run) // 2
        parts = [
            _counted(run[low:high], np.arange(low, high) if groups is None else groups[low:high])
            for low, high in ((0, half), (half, len(run)))
        ]
        return tuple(np.concatenate(values) for values in zip(*parts, strict=True))
    of = of.astype(np.uint64)
    zero = np.uint64(0)
    one, two, three = symbols[:-2], symbols[1:-1], symbols[2:]
    keys = []
    for kind, parts in enumerate(((symbols,), (symbols[:-1], symbols[1:]), (one, two, three))):
        code = of[: len(parts[0])] * np.uint64(4) + np.uint64(kind)
        for k in range(3):
            code = (code << bits) | (parts[k] if k < len(parts) else zero)
        keys.append(code[(symbols > 0, slice(None), two > 0)[kind]])
    keys = np.concatenate(keys)
    keys.sort()
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
    new = new.astype(np.int64)
    counts = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    mask = (np.uint64(1) << bits) - np.uint64(1)
    points = np.concatenate([[np.uint64(0)], alphabet.astype(np.uint64)])
    factors = constants(4, 13)
    total = ((keys >> (bits * np.uint64(3))) & np.uint64(3)) * factors[3]
    for k in range(3):
        total += points[(keys >> (bits * np.uint64(2 - k))) & mask] * factors[k]
    return numbers[(keys >> (bits * np.uint64(3) + np.uint64(2))).astype(np.int64)], mix(total), counts


def _ranked(run: list[str], size: int):
    """Each text's profile: the text, the n-gram's hash and its rank."""
    rows, grams, counts = _counted(run)
    begin = np.searchsorted(rows, np.arange(len(run) + 1))
    inside = np.arange(len(rows)) - begin[rows]
    most = (1 << 24) - 1
    if max(counts.max(initial=0), inside.max(initial=0)) <= most:
        # One sort of packed numbers, which all but texts of gigabytes allow.
        order = (rows << 48) | ((most - counts) << 24) | inside
        order.sort()
        at, of = begin[order >> 48] + (order & most), order >> 48
    else:
        at = np.lexsort((inside, -counts, rows))
        of = rows[at]
    rank = np.arange(len(rows)) - begin[of]
    return of[rank < size], grams[at[rank < size]], rank[rank < size]


def learn_profiles(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = SIZE
) -> dict[str, list[int]]:
    """Each language's n-grams by rank, over all rows with a text and a language."""
    rows = bounded(docs).select(docs[lang_col].alias("lang"), docs[text_col].alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        held = [np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)]

        def summed(parts):
            lang, gram, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((gram, lang))
            lang, gram, n = lang[order], gram[order], n[order]
            new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (lang[1:] != lang[:-1])])
            at = np.flatnonzero(new[: len(gram)])
            return [lang[at], gram[at], np.add.reduceat(n, at) if len(at) else n]

        def out(held):
            lang = pc.take(pa.array(names, pa.string()), pa.array(held[0]))
            columns = [lang, pa.array(held[1].view(np.int64)), pa.array(held[2])]
            return pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

        for batch in batches:
            languages = batch.column(0).to_pylist()
            names += [x for x in dict.fromkeys(languages) if x not in names]
            number = np.array([names.index(x) for x in languages], np.int64)
            for first, run in _parts(batch.column(1).to_pylist()):
                held = summed([held, _counted(run, number[first : first + len(run)])])
            if len(held[0]) > GRAMS:
                yield out(held)
                held = [x[:0] for x in held]
        if len(held[0]):
            yield out(held)

    counts = (
        rows.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    # The first of each language within each part of its n-grams, then the first of those.
    part = F.pmod("gram", F.lit(64))
    for keys in (["lang", part], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("n"), "gram")
        counts = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    found: dict[str, dict[int, int]] = {}
    rows = counts.limit(size * MAX_LANGUAGES + 1).collect()
    if len(rows) > size * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    for row in rows:
        found.setdefault(row["lang"], {})[row["rank"]] = row["gram"]
    return {lang: [grams[k] for k in sorted(grams)] for lang, grams in sorted(found.items())}


def predict_languages(
    docs: DataFrame,
    profiles: dict[str, list[int]],
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
) -> DataFrame:
    """``(id_col, lang_pred, score)`` for every row, from its text alone."""
    names = sorted(profiles)
    known = np.array([g for name in names for g in profiles[name]], np.int64).view(np.uint64)
    theirs = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(profiles[n])) for n in names)])
    whose = np.repeat(np.arange(len(names)), [len(profiles[n]) for n in names])
    order = np.argsort(known, kind="stable")
    # Each n-gram's languages and ranks stand together: as much as the profiles, whose number is
    # checked, and not n-grams times languages.
    sent = docs.sparkSession.sparkContext.broadcast(
        (known[order], whose[order].astype(np.int32), theirs[order].astype(np.int32))
    )
    texts = bounded(docs).select(docs[id_col], docs[text_col].alias("__text"))

    def nearest(rows, found, rank, count):
        """Of each text the language at least distance, and that; texts by part, to bound memory."""
        known, whose, theirs = sent.value
        best, least = np.zeros(count, np.int64), np.zeros(count)
        low, high = np.searchsorted(known, found), np.searchsorted(known, found, "right")
        step = max(1, CELLS // max(1, len(names)))
        for begin in range(0, count, step):
            end = min(begin + step, count)
            part = slice(*np.searchsorted(rows, (begin, end)))
            many = high[part] - low[part]
            at = np.repeat(low[part] - np.cumsum(many) + many, many) + np.arange(many.sum())
            near = np.maximum(size - np.abs(theirs[at] - np.repeat(rank[part], many)), 0)
            cell = (np.repeat(rows[part], many) - begin) * len(names) + whose[at]
            # An n-gram that a language does not rank is ``size`` away.
            shared = np.bincount(cell, near, (end - begin) * len(names)).reshape(-1, len(names))
            away = size * np.bincount(rows[part] - begin, minlength=end - begin)[:, None] - shared
            best[begin:end], least[begin:end] = away.argmin(1), away.min(1)
        return best, least

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = np.array([*names, "und"], object)
        for batch in batches:
            for first, run in _parts(batch.column(1).to_pylist()):
                rows, found, rank = _ranked(run, size)
                best, score = np.full(len(run), len(names)), np.zeros(len(run))
                if len(rows) and len(names):
                    near, least = nearest(rows, found, rank, len(run))
                    most = size * np.bincount(rows, minlength=len(run))
                    some = most > 0
                    best[some], score[some] = near[some], 1 - least[some] / most[some]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(run)), pa.array(labels[best], pa.string()),
                     pa.array(score)],
                    [id_col, "lang_pred", "score"],
                )

    kind = texts.schema[0].dataType.simpleString()
    return texts.mapInArrow(predict, f"`{id_col}` {kind}, lang_pred string, score double")


def fold(id_column: Column, folds: int = 5) -> Column:
    """The fold of a row: CRC-32 of its id as text, modulo ``folds``."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds


def identify(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, lang_pred, score)``, learned from the folds other than 0."""
    profiles = learn_profiles(docs.where(fold(docs[id_col]) != 0), lang_col, text_col)
    found = predict_languages(docs, profiles, id_col, text_col)
    held = F.coalesce(fold(F.col(id_col)) == 0, F.lit(False))
    return found.select(id_col, held.alias("held_out"), "lang_pred", "score")
