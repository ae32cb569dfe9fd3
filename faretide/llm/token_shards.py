"""Token ids in training order: fixed-stride binary shards in an order that a key decides.

Token ids of all rows are put end to end, each document closed by ``END``, and cut into sequences
of a fixed length. Ids come from an array column, or packed in a binary one, and are written
little-endian in 2 or 4 bytes; or a text column gives its UTF-8 bytes as ids of one byte. A stride is ``length * width`` bytes. A Feistel permutation with cycle-walking, keyed by a seed, gives every sequence
its slot in the order of training: a bijection of ``0 .. n-1`` that is computed, not stored. A
range of slots is one shard. Slots are sent to their shard's partition, sorted there, and written
as records of one stride, so the record of slot s is at ``(s - first slot) * stride`` of its shard
and reading can go on at any slot.

Sequences are numbered by input partition: a first pass adds up tokens per partition, a second
numbers each partition's sequences from its start. Both must see the same partitions, so the rows
are to come from files (a staged table) and not from a shuffle; the second pass fails if a
partition has not the tokens it was counted with. No document or sequence passes through the driver,
which holds a number a partition and a row a shard. A lost or repeated task writes the same bytes: a shard is
written under a name of its own and then moved into place.

Defined results: a NULL or empty text or array is one ``END``. An empty table gives no shard. Each
partition's last sequence is filled up with ``PAD``. Repeated rows are written each. Other columns
are not read. An id that is NULL, does not fit its width, or is ``END`` or ``PAD`` fails the run.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide.llm.words import bounded, constants, mix

#: For texts, byte values are token ids themselves; UTF-8 never has these two.
END, PAD = 0xFF, 0xFE
#: Bytes of an id: how ids are stored. ``END`` and ``PAD`` are by default the two largest.
WIDTHS = {1: np.dtype("u1"), 2: np.dtype("<u2"), 4: np.dtype("<u4")}
LENGTH = 1024
SHARD_BYTES = 32 << 20
FEISTEL_ROUNDS = 4


def permuted(numbers: np.ndarray, count: int, key: int) -> np.ndarray:
    """A keyed bijection of ``0 .. count-1``, at the given numbers.

    Halves of an even number of bits are swapped and mixed; numbers that leave the range walk on
    along their cycle until they are back in it.
    """
    half = np.uint64(max(1, (max(count - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(constants(FEISTEL_ROUNDS, 23) + np.uint64(key))
    out = numbers.astype(np.uint64)
    walking = np.ones(len(out), bool)
    while walking.any():
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[walking] = (left << half) | right
        walking = out >= np.uint64(count)
    return out.astype(np.int64)


def qualified(docs: DataFrame, folder: str) -> str:
    """A folder with its scheme: one without is on the default file system, as Spark takes it."""
    context = docs.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    return files.makeQualified(path).toString()


def _filesystem(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _text_bytes(column: pa.Array, end: int) -> tuple[bytes, np.ndarray]:
    """All rows' ids as stored, each closed by ``end``, and how many each row has."""
    texts = [t.as_py() or b"" for t in column]
    close = bytes([end])
    return b"".join([t + close for t in texts]), np.array([len(t) + 1 for t in texts], np.int64)


def _packed_bytes(column: pa.Array, end: int, pad: int, width: int) -> tuple[bytes, np.ndarray]:
    rows, close = [row.as_py() or b"" for row in column], end.to_bytes(width, "little")
    if any(len(row) % width for row in rows):
        raise ValueError(f"packed ids are not of {width} bytes")
    if np.isin(np.frombuffer(b"".join(rows), WIDTHS[width]), (end, pad)).any():
        raise ValueError(f"token ids are END ({end}) or PAD ({pad})")
    return b"".join([row + close for row in rows]), np.array([len(r) // width + 1 for r in rows], np.int64)


def _id_bytes(column: pa.Array, end: int, pad: int, width: int) -> tuple[bytes, np.ndarray]:
    if pa.types.is_binary(column.type):
        return _packed_bytes(column, end, pad, width)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    if flat.null_count:
        raise ValueError("a token id is NULL")
    ids = flat.to_numpy(zero_copy_only=False)
    if len(ids) and (ids.min() < 0 or ids.max() >= 1 << 8 * width or np.isin(ids, (end, pad)).any()):
        raise ValueError(f"token ids do not fit {width} bytes, or are END ({end}) or PAD ({pad})")
    sizes = sizes.astype(np.int64) + 1
    out = np.full(sizes.sum(), end, WIDTHS[width])
    inner = np.ones(len(out), bool)
    inner[np.cumsum(sizes) - 1] = False
    out[inner] = ids
    return out.tobytes(), sizes


def _sequences(
    counted: dict[int, int], begins: dict[int, int], count: int, stride: int, key: int, per: int,
    width: int, end: int, pad: int,
):
    """Cut a partition's tokens into sequences with their slots."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, rest, seen, first = begins.get(part, 0), b"", 0, None

        def out(data: bytes, ids: list):
            nonlocal number
            n = len(data) // stride
            slots = permuted(np.arange(number, number + n), count, key)
            number += n
            tokens = [data[k * stride : (k + 1) * stride] for k in range(n)]
            return pa.RecordBatch.from_arrays(
                [pa.array(slots // per), pa.array(slots), pa.array(ids, pa.int64()),
                 pa.array(tokens, pa.binary())],
                ["shard", "slot", "doc_id", "tokens"],
            )

        for batch in batches:
            for low in range(0, len(batch), 200):
                ids = batch.column(0).slice(low, 200).to_pylist()
                column = batch.column(1).slice(low, 200)
                new, sizes = (
                    _text_bytes(column, end) if width == 1 else _id_bytes(column, end, pad, width)
                )
                data = rest + new
                seen += len(new) // width
                # The document that each sequence's first token is of.
                ends = np.cumsum(sizes) * width + len(rest)
                whole = len(data) // stride
                at = np.searchsorted(ends, np.arange(whole + 1) * stride, "right")
                if rest:
                    at = np.where(np.arange(whole + 1) * stride < len(rest), -1, at)
                owners = [first if k < 0 else ids[min(k, len(ids) - 1)] for k in at.tolist()]
                if whole:
                    yield out(data[: whole * stride], owners[:whole])
                rest, first = data[whole * stride :], owners[whole]
        if seen != counted.get(part, 0):
            raise RuntimeError(f"partition {part} changed between two passes: stage the rows first")
        if rest:
            missing = (stride - len(rest)) // width
            yield out(rest + np.full(missing, pad, WIDTHS[width]).tobytes(), [first])

    return cut


def _write(folder: str, stride: int, per: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(folder)
        shard, stream, name, size = None, None, "", 0

        def close():
            if stream is not None:
                stream.close()
                files.move(name, f"{root}/shard-{shard:08d}.bin")

        for batch in batches:
            shards = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            offsets = np.zeros(len(shards), np.int64)
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if shards[low] != shard:
                    close()
                    shard, size = int(shards[low]), 0
                    name = f"{root}/.writing-{shard:08d}-{uuid.uuid4().hex}"
                    stream = files.open_output_stream(name)
                stream.write(b"".join(batch.column(3).slice(low, high - low).to_pylist()))
                offsets[low:high] = size + np.arange(high - low) * stride
                size += (high - low) * stride
            wanted = (batch.column(1).to_numpy() - shards * per) * stride
            if not np.array_equal(wanted, offsets):
                raise RuntimeError("slots are missing or repeated")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:3], batch.column(0), pa.array(offsets)],
                ["slot", "doc_id", "shard", "offset"],
            )
        close()

    return write


def write_shards(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    key: int = 1,
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    ids_col: str | None = None,
    width: int = 2,
    end: int | None = None,
    pad: int | None = None,
) -> DataFrame:
    """``(slot, doc_id, shard, offset)``: where each sequence is written, as shards are written.

    With ``ids_col`` (an array of ints, or ids packed in ``width`` bytes each) its ids are written
    in ``width`` bytes each, else the bytes of ``text_col``. ``length`` is in ids. ``doc_id`` is the document of the sequence's first token.
    Shards are written into ``folder``, which executors must share, when the result is computed.
    """
    if ids_col is None:
        width = 1
        tokens = F.coalesce(docs[text_col].cast("binary"), F.lit(b""))
        size = F.octet_length("tokens")
    else:
        if width not in (2, 4):
            raise ValueError("ids are written in 2 or 4 bytes")
        packed = isinstance(docs.schema[ids_col].dataType, T.BinaryType)
        tokens = docs[ids_col]
        if not packed:
            tokens = tokens.cast("array<long>" if width == 4 else "array<int>")
        size = F.octet_length("tokens") / width if packed else F.size("tokens")
        size = F.when(F.col("tokens").isNull(), 0).otherwise(size).cast("long")
    top = (1 << 8 * width) - 1
    end, pad = top if end is None else end, top - 1 if pad is None else pad
    if end == pad or not (0 <= end <= top and 0 <= pad <= top):
        raise ValueError(f"END and PAD must differ and fit {width} bytes")
    rows = bounded(docs).select(docs[id_col].cast("long").alias("id"), tokens.alias("tokens"))
    counted = {
        r["part"]: r["tokens"]
        for r in rows.groupBy(F.spark_partition_id().alias("part"))
        .agg(F.sum(size + 1).alias("tokens"))
        .collect()
    }
    begins, count = {}, 0
    for part in sorted(counted):
        begins[part] = count
        count += -(-counted[part] // length)
    stride = length * width
    per = max(1, shard_bytes // stride)
    shards = max(1, -(-count // per))
    folder = qualified(docs, folder)
    files, root = _filesystem(folder)
    files.create_dir(root, recursive=True)
    schema = "shard long, slot long, doc_id long, tokens binary"
    cut = _sequences(counted, begins, count, stride, key, per, width, end, pad)
    return (
        rows.mapInArrow(cut, schema)
        .repartitionById(shards, F.col("shard").cast("int"))
        .sortWithinPartitions("slot")
        .mapInArrow(_write(folder, stride, per), "slot long, doc_id long, shard long, offset long")
    )


def read_slots(
    folder: str,
    first: int,
    count: int,
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    width: int = 1,
):
    """The sequences of ``count`` slots from ``first`` on, one by one, in training order."""
    files, root = _filesystem(folder)
    stride = length * width
    per = max(1, shard_bytes // stride)
    slot, end = first, first + count
    while slot < end:
        shard, record = divmod(slot, per)
        with files.open_input_file(f"{root}/shard-{shard:08d}.bin") as file:
            file.seek(record * stride)
            for _ in range(min(end - slot, per - record)):
                data = file.read(stride)
                if not data:
                    return
                yield np.frombuffer(data, WIDTHS[width])
                slot += 1
