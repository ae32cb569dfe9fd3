"""Byte-pair encoding with a deterministic automaton over tokens, and decoding.

The merges are compiled one after another. At first there is one state, and every symbol's arc
leads back to it. Merging ``u`` and ``v`` adds a gadget: the state behind ``u`` is replaced, for
arcs labelled ``u``, by a copy without the arc ``v``; wherever ``u`` could be followed by ``v`` an
arc ``uv`` is added, which leads where ``v`` led. In the end a sequence of tokens is a path from
the start if and only if applying the merges in order gives it. A state is kept as its parent and
the one arc it lacks, so the automaton grows by one state and one label a merge.

Encoding a word takes its longest token that the present state allows and steps back where a
path ends early; the path is unique. Decoding emits the labels of the arcs. Words are found as
the tokenizer's file says (normal form, added tokens, pattern), and every distinct word of a task
is encoded once.

Defined results: NULL and empty texts have no tokens, an empty ids string and an empty decoded
text. Ids NULL stay NULL, repeated rows are encoded each, other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from faretide.llm import code_points
from faretide.llm.token_paths import Arcs, Trie, paths
from faretide.llm.words import NOT_SPACE, blocks, bounded, received, shared

#: Entries in each generation of a task's tables, and an entry's most letters, which bound memory.
MAX_WORDS = 150_000
LONGEST = 48
#: Letters by which the symbols that may come next are looked up.
WINDOW = 6
START = (0, 0)
FOREVER = 1 << 60
MASK = 0xFFFFFFFF
SPACE, ODD_SPACE = regex.compile(r"\s+"), regex.compile("[\x1c-\x1f]")
#: Bytes of text whose chunks are told apart at a time.
BLOCK = 1 << 22


@dataclass
class Automaton:
    """The states behind a label form a line: its n-th lacks one arc more than the one before.

    ``lines[l]`` has the arcs that line ``l`` lacks and since when; ``up[l]`` is the state it
    began as a copy of. A state is (line, time). Line 0 is the start, which lacks nothing.
    """

    lines: list[dict[int, int]] = field(default_factory=lambda: [{}])
    up: list[tuple[int, int]] = field(default_factory=lambda: [START])
    own: dict[int, int] = field(default_factory=dict)
    target: dict[int, tuple[int, int]] = field(default_factory=dict)
    #: a label's left parts, each with the time at which it became part of the one before
    parts: dict[int, list[tuple[int, int]]] = field(default_factory=dict)

    def add_symbol(self, label: int) -> None:
        self.target[label] = START
        self.parts[label] = [(label, FOREVER)]

    def add_merge(self, time: int, u: int, v: int, label: int) -> bool:
        """The gadget of one merge; false if nothing ever lets ``v`` follow ``u``."""
        behind = self.target[u]
        if not self.allows(behind, v):
            return False
        after = self.target[v]
        if u not in self.own:
            self.own[u] = len(self.lines)
            self.lines.append({})
            self.up.append(behind)
        self.lines[self.own[u]][v] = time
        self.target[u] = (self.own[u], time)
        self.target[label] = after
        (_, _), *rest = self.parts[u]
        self.parts[label] = [(label, FOREVER), (u, time), *rest]
        return True

    def allows(self, state: tuple[int, int], label: int) -> bool:
        """Whether the state has an arc with this label.

        A copy has the arc of a later merge if it had the merge's left part, so each left part
        must not have been lacking when it became part of the next.
        """
        line, made = state
        while line:
            lacks = self.lines[line]
            for part, until in self.parts[label]:
                time = lacks.get(part)
                if time is not None and time <= made and time <= until:
                    return False
            line, made = self.up[line]
        return True


def _byte_letters() -> dict[int, str]:
    """The printable letters that stand for bytes in vocabulary files.

    Fixed values: visible Latin-1 characters stand for themselves, the other bytes in order for
    the characters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


@dataclass
class Encoder:
    """What a tokenizer's file compiles to; sent to executors once, as a broadcast."""

    automaton: Automaton
    symbols: dict[str, int]
    texts: dict[int, str]
    end: str
    #: the longest symbol that begins with these (at most ``WINDOW``) letters
    reach: dict[str, int]
    pattern: str
    added: dict[str, int]
    trie: Trie

    @classmethod
    def from_file(cls, path: str) -> Encoder:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        automaton, made = Automaton(), {u + v for u, v in merges}
        symbols = {t: i for t, i in vocab.items() if t not in made}
        for label in symbols.values():
            automaton.add_symbol(label)
        for time, (u, v) in enumerate(merges, 1):
            label = vocab[u + v]
            if u in symbols and v in symbols and automaton.add_merge(
                time, vocab[u], vocab[v], label
            ):
                symbols[u + v] = label
        reach: dict[str, int] = {}
        for symbol in symbols:
            letters = symbol.removesuffix(end) if end else symbol
            for k in range(1, WINDOW + 1):
                reach[letters[:k]] = max(reach.get(letters[:k], 0), len(letters))
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(
            p["pattern"]["Regex"]
            for p in spec["pre_tokenizer"]["pretokenizers"]
            if p["type"] == "Split"
        )
        texts = {i: t for t, i in vocab.items()} | {i: t for t, i in added.items()}
        # Symbols of letters that stand for no byte begin nowhere.
        byte, tries = {letter: b for b, letter in _byte_letters().items()}, ({}, {})
        for symbol, label in symbols.items():
            final = bool(end) and symbol.endswith(end)
            letters = symbol.removesuffix(end) if final else symbol
            if letters and all(map(byte.__contains__, letters)):
                tries[final][bytes(map(byte.__getitem__, letters))] = label
        trie = Trie.of(tries[0], tries[1] if end else tries[0])
        return cls(automaton, symbols, texts, end, reach, pattern, added, trie)


class _Table(dict):
    """Entries made when first asked for, in two generations of at most ``most``.

    Entries for more than ``LONGEST`` letters are made each time.
    """

    def __init__(self, make, most: int):
        self.most = most
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        if len(key) > LONGEST:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def all(self, keys: list[str], make) -> list:
        """The entries of different keys; ``make`` gives a list of those that are new."""
        found = list(map(self.get, keys))
        asked = [key for key, value in zip(keys, found, strict=True) if value is None]
        if asked:
            values = list(map(self.old.get, asked))
            new = [key for key, value in zip(asked, values, strict=True) if value is None]
            made = iter(make(new) if new else ())
            values = [next(made) if value is None else value for value in values]
            given = iter(values)
            found = [next(given) if value is None else value for value in found]
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            new = zip(asked, values, strict=True)
            long = max(map(len, asked)) > LONGEST
            self.update([(k, v) for k, v in new if len(k) <= LONGEST] if long else new)
        return found


class TextEncoder:
    """Encodes and decodes whole texts; one for each task.

    Ids are decimal numbers joined by spaces or, with a ``width``, little-endian numbers of so many
    bytes one after another, as the tables of words keep them.
    """

    def __init__(self, encoder: Encoder, max_words: int = MAX_WORDS, width: int | None = None):
        self.max_words, self.width = max_words, width
        self.join = b"".join if width else " ".join
        self.encoder = encoder
        self.find = regex.compile(encoder.pattern).findall
        self.find_older = regex.compile(code_points.older(encoder.pattern), regex.V1).findall
        self.find_or_break = regex.compile(f"{encoder.pattern}|\n").findall
        parts = sorted(encoder.added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, parts)) + ")").split
        self.letters = _byte_letters()
        self.arcs: dict[int, bool] = {}
        self.arc_table: Arcs | None = None
        self.words = _Table(self._word, max_words)
        self.steps = _Table(self._step, max_words)
        spell = (lambda i: i.to_bytes(width, "little")) if width else str
        self.spelled = {i: spell(i) for i in encoder.texts}
        self.chunks = _Table(lambda chunk: self._chunk(chunk, self.find), max_words)
        self.texts = {i if width else str(i): text for i, text in encoder.texts.items()}

    def _arc(self, last: int, label: int) -> bool:
        found = self.encoder.automaton.allows(self.encoder.automaton.target[last], label)
        if len(self.arcs) >= 10 * self.max_words:
            self.arcs.clear()
        self.arcs[last << 20 | label] = found
        return found

    def _spelled(self, ids: list[int]) -> str | bytes:
        return self.join(map(self.spelled.__getitem__, ids))

    def _chunk(self, chunk: str, find) -> str | bytes:
        """The ids of a text without white space."""
        return self.join(map(self.words.__getitem__, find(chunk)))

    def _word(self, word: str) -> str | bytes:
        """A word's ids."""
        letters = word
        if not word.isascii() or not word.isprintable():
            letters = "".join(map(self.letters.__getitem__, word.encode()))
        return self._spelled(self.word(letters))

    def _step(self, window: str) -> int:
        """The longest symbol that may begin with these letters, and which of their prefixes are symbols.

        Bit n says whether the first n are one; bit 0 is always set. The length is above these bits.
        """
        symbols, bits = self.encoder.symbols, 1
        for n in range(1, len(window) + 1):
            if window[:n] in symbols:
                bits |= 1 << n
        longest = self.encoder.reach.get(window) or max(1, bits.bit_length() - 1)
        return longest << WINDOW + 1 | bits

    def word(self, letters: str) -> list[int]:
        """The labels of a word's path, given as letters that stand for bytes."""
        get, arcs, steps = self.encoder.symbols.get, self.arcs, self.steps
        # The last letter carries the word's end: it is one symbol with it.
        size, ended = len(letters), letters + self.encoder.end
        label = get(ended)
        if label is not None:
            return [label]
        labels: list[int] = []
        begins: list[int] = []
        at, last, step = 0, -1, steps[letters[:WINDOW]]
        stop = step >> WINDOW + 1
        while True:
            if stop >= size:
                stop, label = size, get(ended[at:])
            else:
                label = get(letters[at:stop])
            if label is not None:
                follows = last < 0 or arcs.get(last << 20 | label)
                if follows is None:
                    follows = self._arc(last, label)
                if follows:
                    labels.append(label)
                    if stop == size:
                        return labels
                    begins.append(at)
                    at, last = stop, label
                    step = steps[letters[at : at + WINDOW]]
                    stop = at + (step >> WINDOW + 1)
                    continue
            # The next shorter symbol or, beyond the window, one letter less.
            n = stop - at
            stop = stop - 1 if n > WINDOW else at + (step & (1 << n) - 1).bit_length() - 1
            while stop == at:
                if not labels:
                    raise ValueError(f"no tokens spell {letters!r}")
                # No arc leads on from here: a shorter token before.
                labels.pop()
                stop, at = at, begins.pop()
                step = steps[letters[at : at + WINDOW]]
                n = stop - at
                stop = stop - 1 if n > WINDOW else at + (step & (1 << n) - 1).bit_length() - 1
                last = labels[-1] if labels else -1

    def _normal(self, part: str, later: bool = False) -> str:
        part = code_points.composed(part) if later else unicodedata.normalize("NFC", part)
        # Python alone lowers a sigma by its place in the word.
        return part.replace("\u03a3", "\u03c3").lower()

    def _some_words(self, words: list[str]) -> list[bytes]:
        """Each word's ids; ``LONGEST`` bytes and more are left to :meth:`word`."""
        if self.arc_table is None:
            self.arc_table = Arcs(self.arcs, self._arc)
        found: list[bytes] = [b""] * len(words)
        letters = [word.encode() for word in words]
        sizes = np.fromiter(map(len, letters), np.int64, len(letters))
        short = np.flatnonzero(sizes < LONGEST).tolist()
        data = np.frombuffer(b"".join(map(letters.__getitem__, short)), np.uint8)
        offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes[short])])
        labels, counts, given_up = paths(self.encoder.trie, self.arc_table, data, offsets)
        ids = labels.astype(f"<u{self.width}").tobytes()
        cuts = np.concatenate([[0], np.cumsum(counts) * self.width]).tolist()
        for n, low, high in zip(short, cuts, cuts[1:]):
            found[n] = ids[low:high]
        left = [short[n] for n in np.flatnonzero(given_up).tolist()]
        for n in left + np.flatnonzero(sizes >= LONGEST).tolist():
            found[n] = self._word(words[n])
        return found

    def _some_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of texts without white space, whose words are looked for at once."""
        found = self.find_or_break("\n".join(chunks))
        if found.count("\n") != len(chunks) - 1:
            return [self._chunk(chunk, self.find) for chunk in chunks]
        different = list(set(found) - {"\n"})
        ids = dict(zip(different, self.words.all(different, self._some_words), strict=True))
        ids["\n"] = b""
        parts = list(map(ids.__getitem__, found))
        joined = b"".join(parts)
        # A word has an id at least: only a break between chunks is empty.
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        cuts = [0, *np.cumsum(sizes)[sizes == 0].tolist(), len(joined)]
        return [joined[low:high] for low, high in zip(cuts, cuts[1:])]

    def encode_all(self, column: pa.Array) -> pa.Array:
        """The ids of a column's texts, for a ``width``; each chunk is looked up once a block."""
        texts, alone = [], {}
        for n, text in enumerate(column):
            text = text.as_py() or ""
            odd = not text.isascii() and code_points.odd(text)
            if (odd and code_points.found_in(text)) or (
                "<" in text and any(map(text.__contains__, self.encoder.added))
            ):
                alone[n], text = self.encode(text), ""
            text = self._normal(text)
            if odd:
                text = SPACE.sub(" ", text)
            texts.append(text)
        rows = [self._block(block) for block in blocks(pa.array(texts, pa.string()), BLOCK)]
        rows = pa.concat_arrays(rows) if rows else pa.array([], pa.binary())
        if alone:
            rows = pa.array([alone.get(n, r) for n, r in enumerate(rows.to_pylist())], pa.binary())
        return rows

    def _block(self, block) -> pa.Array:
        start, end, first = block.spans()
        if not len(start):
            return pa.array([b""] * block.rows, pa.binary())
        offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
        letters = block.data[NOT_SPACE[block.data]]
        chunks = pa.StringArray.from_buffers(
            len(start), pa.py_buffer(offsets), pa.py_buffer(letters)
        ).dictionary_encode()
        different = pa.ListArray.from_arrays([0, len(chunks.dictionary)], chunks.dictionary)
        different = pc.binary_join(different, "\n")[0].as_py().split("\n")
        ids = self.chunks.all(different, self._some_chunks)
        ids = pa.array(ids, pa.binary()).take(chunks.indices)
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int32)[: len(ids) + 1][first]
        return pa.BinaryArray.from_buffers(
            pa.binary(), block.rows, [None, pa.py_buffer(ends), data]
        )

    def encode(self, text: str) -> str | bytes:
        """The text's ids."""
        parts = self.split(text) if "<" in text else (text,)
        found: list[str | bytes] = []
        for k, part in enumerate(parts):
            if k % 2:
                found.append(self._spelled([self.encoder.added[part]]))
                continue
            later = not part.isascii() and code_points.found_in(part)
            part = self._normal(part, later)
            # Python alone takes these four for white space.
            chunks = SPACE.split(part) if ODD_SPACE.search(part) else part.split()
            if later:
                chunks = [c.translate(code_points.LOWERED) for c in chunks]
                ids = [self._chunk(c, self.find_older) for c in chunks]
            else:
                ids = map(self.chunks.__getitem__, chunks)
            found.extend(filter(None, ids))
        return self.join(found)

    def decode(self, ids: str | bytes) -> str:
        """The labels of the ids' arcs, joined as the tokenizer joins tokens."""
        if not ids:
            return ""
        parts = np.frombuffer(ids, f"<u{self.width}").tolist() if self.width else ids.split(" ")
        return " ".join(map(self.texts.__getitem__, parts))


def encode_texts(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digests: bool = False,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """``(id_col, n_tokens, ids, decoded)`` of every text.

    ``digests`` gives ``ids_sha256`` and ``decoded_sha256`` in their place.
    """
    texts = bounded(docs).select(docs[id_col], docs[text_col].cast("string").alias("__text"))
    sent = shared(docs, Encoder.from_file(path))
    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(received(sent), max_words)
        for batch in batches:
            column = batch.column(1)
            for low in range(0, len(column), 500):
                part = column.slice(low, 500)
                counts, ids, decoded = [], [], []
                for text in part:
                    one = encoder.encode(text.as_py() or "")
                    count, back = one.count(" ") + bool(one), encoder.decode(one)
                    if digests:
                        one, back = (
                            hashlib.sha256(one.encode()).hexdigest(),
                            hashlib.sha256(back.encode()).hexdigest(),
                        )
                    counts.append(count)
                    ids.append(one)
                    decoded.append(back)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, 500), pa.array(counts, pa.int64()),
                     pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    [id_col, "n_tokens", *names],
                )

    kind = texts.schema[0].dataType.simpleString()
    return texts.mapInArrow(
        encode, f"`{id_col}` {kind}, n_tokens long, {names[0]} string, {names[1]} string"
    )


def _packed(column: pa.Array, encoder: TextEncoder, decoded: list | None = None) -> list[bytes]:
    found = []
    for text in column:
        found.append(encoder.encode(text.as_py() or ""))
        if decoded is not None:
            decoded.append(encoder.decode(found[-1]))
    return found


def _id_lists(found: list[bytes], width: int) -> tuple[np.ndarray, pa.Array]:
    """How many ids each row has, and the ids as lists of ints."""
    counts = np.array([len(one) // width for one in found], np.int64)
    ids = np.frombuffer(b"".join(found), f"<u{width}").astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return counts, pa.ListArray.from_arrays(ends, pa.array(ids))


def token_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_words: int = MAX_WORDS,
    packed: bool = False,
) -> DataFrame:
    """``(id_col, ids)`` of every text; nothing is decoded.

    Ids are an array of ints or, ``packed``, little-endian numbers of :func:`id_width` bytes.
    """
    texts = bounded(docs).select(docs[id_col], docs[text_col].cast("string").alias("__text"))
    encoder = Encoder.from_file(path)
    width, sent = id_width(encoder), shared(docs, encoder)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(received(sent), max_words, width)
        for batch in batches:
            found = encoder.encode_all(batch.column(1))
            ids = found if packed else _id_lists(found.to_pylist(), width)[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], [id_col, "ids"])

    kind = texts.schema[0].dataType.simpleString()
    return texts.mapInArrow(encode, f"`{id_col}` {kind}, ids {'binary' if packed else 'array<int>'}")


def id_width(encoder: Encoder) -> int:
    """Bytes that hold any id of a tokenizer, and two numbers above them."""
    return 2 if max(encoder.texts) < (1 << 16) - 2 else 4


def token_lists(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """``(id_col, n_tokens, ids, decoded_sha256)``, ids as an array of ints."""
    texts = bounded(docs).select(docs[id_col], docs[text_col].cast("string").alias("__text"))
    encoder = Encoder.from_file(path)
    width, sent = id_width(encoder), shared(docs, encoder)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(received(sent), max_words, width)
        for batch in batches:
            column = batch.column(1)
            for low in range(0, len(column), 500):
                decoded: list[str] = []
                counts, ids = _id_lists(_packed(column.slice(low, 500), encoder, decoded), width)
                digests = [hashlib.sha256(text.encode()).hexdigest() for text in decoded]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, 500), pa.array(counts), ids,
                     pa.array(digests, pa.string())],
                    [id_col, "n_tokens", "ids", "decoded_sha256"],
                )

    kind = texts.schema[0].dataType.simpleString()
    return texts.mapInArrow(
        encode, f"`{id_col}` {kind}, n_tokens long, ids array<int>, decoded_sha256 string"
    )
