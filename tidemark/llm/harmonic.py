"""Harmonic packing of tokenized documents that may be cut anywhere.

Class k holds pieces longer than capacity / (k + 1) and up to capacity / k, and a bin of class k takes exactly k of them. A document gives as many
full pieces as it holds; what is left is cut at the largest reciprocal (capacity / k, rounded down) again and again, until a piece is
so near to the top of its class that a bin of such pieces is full but for a share ``waste``.

Every task fills the bins of each class with its own pieces, in their order, so nothing is shuffled and no task waits for
another. It holds the pieces of bins that are still open: less than one bin a class. At its end those are cut into powers of two,
classes whose bins have no padding at all, and a class's last pieces make sequences whose lengths are powers of two themselves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from tidemark.llm.common import ship
from tidemark.llm.packing import tokenizer, vocabulary

#: Share of a bin that may stay free before a piece is cut further.
WASTE = 1 / 64


def cut_lengths(n: int, capacity: int, waste: float = WASTE) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in its order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest > waste * capacity:
            k += 1  # the next class's top is the largest reciprocal below the rest
            out.append(capacity // k)
        else:
            out.append(rest)
        rest -= out[-1]
    return out


def powers(n: int) -> list[int]:
    """``n`` as a sum of powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def closed_bins(sizes: np.ndarray, per_bin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pieces of classes that take ``per_bin`` pieces: their order by class, and which of that order belong to full bins."""
    order = np.argsort(sizes, kind="stable")
    _, first, n = np.unique(sizes[order], return_index=True, return_counts=True)
    place = np.arange(len(order)) - np.repeat(first, n)
    k = per_bin[order]
    return order, place < np.repeat(n, n) // k * k


def offsets_within(lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Start of each piece in its sequence; ``first`` marks the pieces that open one."""
    before = np.cumsum(lengths) - lengths
    return before - before[np.flatnonzero(first)][np.cumsum(first) - 1]


class Packer:
    """The open bins of one task, and the number of its next sequence."""

    def __init__(self, task: int, capacity: int, waste: float):
        self.next, self.capacity, self.waste = task << 40, capacity, waste
        self.ids: list = []  # an Arrow array of carried ids for the open pieces
        self.open: list[tuple[int, int, np.ndarray]] = []  # (start, tokens of the document, ids)

    def rows(self, carried: pa.Array, pieces: list, first: np.ndarray) -> list:
        """Columns of whole sequences; ``pieces`` in their order, ``first`` marks the openers."""
        lengths = np.array([len(p[2]) for p in pieces], dtype=np.int64)
        sequence = self.next + np.cumsum(first) - 1
        self.next += int(first.sum())
        crc = [zlib.crc32(p[2].tobytes()) for p in pieces]
        return [carried, pa.array([p[0] for p in pieces], pa.int64()), pa.array(lengths), pa.array(crc, pa.int64()), pa.array([p[1] for p in pieces], pa.int64()), pa.array(sequence), pa.array(offsets_within(lengths, first))]

    def take(self, carried: pa.Array, documents: list[np.ndarray]) -> list | None:
        """Columns of the sequences that these documents close; ids and pieces of the others are kept."""
        of, pieces = [], self.open
        known = len(pieces)
        for row, ids in enumerate(documents):
            start = 0
            for length in cut_lengths(len(ids), self.capacity, self.waste):
                of.append(row)
                pieces.append((start, len(ids), ids[start : start + length].copy()))
                start += length
        carried = carried.take(pa.array(of, pa.int64()))
        carried = pa.concat_arrays([*self.ids, carried]) if known else carried
        per_bin = self.capacity // np.array([len(p[2]) for p in pieces], dtype=np.int64)
        order, full = closed_bins(per_bin, per_bin)
        done, left = order[full], np.sort(order[~full])
        self.ids, self.open = [carried.take(pa.array(left))], [pieces[i] for i in left]
        if not len(done):
            return None
        n = per_bin[done]
        _, at, count = np.unique(n, return_index=True, return_counts=True)
        first = (np.arange(len(n)) - np.repeat(at, count)) % n == 0
        return self.rows(carried.take(pa.array(done)), [pieces[i] for i in done], first)

    def finish(self) -> list | None:
        """Columns of the sequences that the open pieces give, cut into powers of two."""
        of, pieces = [], []
        for row, (start, whole, ids) in enumerate(self.open):
            at = 0
            for length in powers(len(ids)):
                of.append(row)
                pieces.append((start + at, whole, ids[at : at + length]))
                at += length
        if not pieces:
            return None
        sizes = np.array([len(p[2]) for p in pieces], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        first = np.zeros(len(order), dtype=bool)
        values, at, count = np.unique(sizes[order], return_index=True, return_counts=True)
        for size, begin, n in zip(values.tolist(), at.tolist(), count.tolist(), strict=True):
            most = powers(self.capacity // size)[0]  # pieces of this size in the largest power of two that the capacity holds
            place = 0
            for bin_size in [*[most] * (n // most), *powers(n % most)]:
                first[begin + place] = True
                place += bin_size
        return self.rows(self.ids[0].take(pa.array(np.array(of, dtype=np.int64)[order])), [pieces[i] for i in order], first)


def pack_harmonic(docs: DataFrame, path: str, pattern: str, capacity: int = 1024, waste: float = WASTE, end_id: int = 0) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text): start, length, ids_crc32, doc_tokens, sequence_id and offset.

    A sequence holds at most ``capacity`` tokens. Null and empty texts are the end id alone; rows without an id or that repeat one are
    documents of their own; an empty table gives none; further columns are ignored. Sequence numbers name the task, so a task that is run again gives the same.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(docs.sparkSession)
    numbers = StructType.fromDDL("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *numbers.fields])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = tokenizer(path, pattern), Packer(TaskContext.get().partitionId(), capacity, waste)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            documents = [np.append(encode(text or ""), end).astype("<u4") for text in batch.column(1).to_pylist()]
            if columns := packer.take(batch.column(0).cast(out[0].type), documents):
                yield pa.RecordBatch.from_arrays(columns, schema=out)
        if packer.open and (columns := packer.finish()):
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op12(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` in sequences of at most 1024 tokens."""
    return pack_harmonic(spark.read.parquet(f"{sf_dir}/documents.parquet"), *vocabulary())
