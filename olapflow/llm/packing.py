"""Packing documents into training sequences along a space-filling curve.

A document's token ids are hashed into a vector of fixed width, which a random matrix
projects to a few dimensions. The Hilbert index of that point is the sort key: documents
with similar wording lie near each other on the curve, so the documents of a sequence are
neighbours. The encoded documents are range-sorted by the key, and each range is packed
as one stream: sequences are filled to the last place, documents cut where one ends. What
remains at the end of a range becomes sequences whose lengths are powers of two, which
need no padding.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from olapflow.llm.base import stored
from olapflow.llm.tokenizer import _Kept, load

#: Tokens of a sequence, the id that ends a document, tokens one task packs at least and
#: at most (about).
LENGTH, END_ID, TASK_LEAST, TASK_MOST = 2_048, 1, 131_072, 33_554_432

#: Width of the hashed vectors, dimensions of the curve, and bits of each.
_WIDTH, _DIMS, _BITS = 256, 4, 12

_IDS: dict[str, _Kept] = {}


def _word_ids(path: str) -> _Kept:
    if path not in _IDS:
        _IDS[path] = _Kept(load(path).word_ids)
    return _IDS[path]


@functools.cache
def _places(size: int) -> np.ndarray:
    """Where each id adds to a hashed vector; the second half of the places counts down."""
    mixed = np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    down = (mixed >> np.uint64(55)) & np.uint64(1)
    return ((mixed >> np.uint64(56)) + np.uint64(_WIDTH) * down).astype(np.int64)


def hashed_vectors(ids: list[np.ndarray]) -> np.ndarray:
    """Signed feature hashing of token ids, damped by a square root, of unit length."""
    places = _places(1 << max(16, max((int(own.max()) for own in ids if len(own)), default=0).bit_length()))
    counts = np.array([np.bincount(places[own], minlength=2 * _WIDTH) for own in ids], np.float64).reshape(len(ids), 2 * _WIDTH)
    out = counts[:, :_WIDTH] - counts[:, _WIDTH:]
    out = np.sign(out) * np.sqrt(np.abs(out))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Index on the Hilbert curve of points on a grid of ``_BITS`` bits per dimension."""
    x = points.astype(np.int64).T.copy()
    top = 1 << (_BITS - 1)
    q = top
    while q > 1:  # undo the rotations of each level
        for i in range(_DIMS):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(flip, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, _DIMS):  # Gray code
        x[i] ^= x[i - 1]
    carry = np.zeros_like(x[0])
    q = top
    while q > 1:
        carry = np.where((x[-1] & q) != 0, carry ^ (q - 1), carry)
        q >>= 1
    x ^= carry
    key = np.zeros_like(x[0])
    for bit in range(_BITS - 1, -1, -1):
        for i in range(_DIMS):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of each document. The grid is fixed: coordinates of a projected unit
    vector are near normal, and their distribution function spreads them evenly."""
    matrix = np.random.default_rng(7).standard_normal((_WIDTH, _DIMS))
    spread = np.vectorize(lambda v: 0.5 * (1.0 + math.erf(v / math.sqrt(2.0))), otypes=[float])
    grid = np.floor(spread(hashed_vectors(ids) @ matrix) * (1 << _BITS)).astype(np.int64) if ids else np.zeros((0, _DIMS), np.int64)
    return hilbert_keys(np.clip(grid, 0, (1 << _BITS) - 1))


def encode(docs: DataFrame, path: str, text: str, doc_id: str, end_id: int) -> DataFrame:
    """``doc_id``, ``key``, ``n`` (tokens with the end id) and ``ids`` (little-endian, two
    bytes each where the vocabulary allows) of each document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = f"<u{load(path).width}"
    schema = StructType([
        StructField("doc_id", rows.schema["doc_id"].dataType), StructField("key", LongType()),
        StructField("n", LongType()), StructField("ids", BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, look, end = load(path), _word_ids(path).__getitem__, np.array([end_id], kind).tobytes()
        for batch in batches:
            packed = []
            for value in batch.column(1).cast(pa.binary()).to_pylist():
                if not value:
                    packed.append(end)
                elif tokenizer.by_word:
                    packed.append(b"".join(map(look, value.split())) + end)
                else:
                    packed.append(tokenizer.text_ids(value.decode("utf-8", "replace")) + end)
            ids = [np.frombuffer(p, kind) for p in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(curve_keys(ids)), pa.array([len(i) for i in ids], pa.int64()), pa.array(packed, pa.binary())],
                ["doc_id", "key", "n", "ids"],
            )

    return rows.mapInArrow(run, schema)


def _stream(batches: Iterator[pa.RecordBatch], kind: str, length: int, first: int) -> Iterator[pa.RecordBatch]:
    """Pack one sorted range. Only the pieces of the sequence being filled are held."""
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    held: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the open sequence
    used, sequence = 0, first

    def emit(pieces, id_type):
        columns = list(zip(*pieces, strict=True))
        types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def rows(pieces, number):
        at = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids), ids.tobytes(), total, number, at
            at += len(ids)

    id_type = pa.null()
    for batch in batches:
        id_type, done = batch.schema.field("doc_id").type, []
        for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            ids = np.frombuffer(packed, kind).astype("<u4")
            at = 0
            while at < len(ids):
                piece = ids[at : at + length - used]
                held.append((doc_id, at, piece, len(ids)))
                used, at = used + len(piece), at + len(piece)
                if used == length:
                    done.extend(rows(held, sequence))
                    held, used, sequence = [], 0, sequence + 1
        if done:
            yield emit(done, id_type)
    tail = []
    while used:  # lengths that are powers of two, the largest first
        room, part = 1 << (used.bit_length() - 1), []
        used -= room
        while room:
            doc_id, at, ids, total = held.pop(0)
            part.append((doc_id, at, ids[:room], total))
            if len(ids) > room:
                held.insert(0, (doc_id, at + room, ids[room:], total))
            room -= min(room, len(ids))
        tail.extend(rows(part, sequence))
        sequence += 1
    if tail:
        yield emit(tail, id_type)


def pack(
    docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens (a power of two) under the tokenizer file ``path``.

    One row per piece: ``doc_id``, ``start`` (its document's ids before it), ``length``,
    ``ids`` (little-endian, four bytes each), ``doc_tokens``, ``sequence_id`` and
    ``offset`` in the sequence, gapless from 0. Sequences are full or have a power of two
    as length, so none needs padding.

    A null or empty text is the end id alone. Repeated and tied rows are packed each by
    itself; a null id stays null. Other columns are not read. An empty table gives an
    empty result. A range boundary may fall between equal keys, so copies are spread over
    as many tasks as their tokens ask for.
    """
    encoded = stored(encode(docs, path, text, doc_id, end_id), "packing")
    tokens = encoded.agg(F.sum("n")).first()[0] or 0
    shuffle = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, tokens // TASK_MOST, min(shuffle, tokens // TASK_LEAST))
    kind = f"<u{load(path).width}"
    order = ["key", F.xxhash64("doc_id"), "doc_id", "n", F.crc32("ids")]
    schema = StructType([
        encoded.schema["doc_id"], *[StructField(c, LongType()) for c in ("start", "length")], StructField("ids", BinaryType()),
        *[StructField(c, LongType()) for c in ("doc_tokens", "sequence_id", "offset")],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _stream(batches, kind, length, TaskContext.get().partitionId() << 40)

    ranges = encoded.select("doc_id", "key", "n", "ids").repartitionByRange(tasks, *order)
    return ranges.sortWithinPartitions(*order).select("doc_id", "ids").mapInArrow(run, schema)
