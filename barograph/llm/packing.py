"""Minimum bin slack packing of documents into sequences of at most ``capacity`` tokens.

Whole windows of a document are sequences of their own. What remains of it, shorter than a
window, goes to a bucket of about ``bucket_rows`` remainders. In a bucket, windows are filled one after
the other: a subset-sum table over the distinct remaining lengths (bit s of a Python integer: sum s can be
reached) finds the multiset that fills the window closest to its capacity, starting with the longest
remainder; counts are backtracked from the tables, and a multiset is used as often as the counts allow.
When no multiset comes within ``slack`` tokens, the window takes the best one and the head of the next
longest remainder, cut to fit; its tail stays in the bucket. So at most one window of a
bucket is not full. Buckets are by hash of a row number: repeated ids and copies spread evenly.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tokens import Tokens


@dataclass(frozen=True)
class Packing:
    """capacity: tokens of a sequence. end: the id behind each document. vocabulary: a tokenizer file."""

    capacity: int = 1024
    end: int = 0
    slack: int = 0
    bucket_rows: int = 4096
    vocabulary: str | None = None


def fill(lengths: list[int], counts: Counter, room: int) -> Counter:
    """The multiset of ``lengths`` (distinct, with counts) whose sum comes closest to ``room`` from below.

    Longer lengths are preferred where several reach the same sum.
    """
    mask = (1 << (room + 1)) - 1
    tables, reach = [], 1
    for length in lengths:
        tables.append((reach, length))
        # Up to counts[length] copies, in binary steps.
        left, step = min(counts[length], room // length), 1
        while left > 0:
            take = min(step, left)
            reach |= (reach << (length * take)) & mask
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: Counter = Counter()
    for before, length in reversed(tables):
        while not before >> total & 1:
            chosen[length] += 1
            total -= length
    return chosen


def pack(lengths: np.ndarray, capacity: int, slack: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (row, start in the row, length); every row of ``lengths`` is used up."""
    stock: dict[int, list[tuple[int, int]]] = {}
    for row in range(len(lengths) - 1, -1, -1):
        if lengths[row]:
            stock.setdefault(int(lengths[row]), []).append((row, 0))
    left = Counter({k: len(v) for k, v in stock.items()})

    def take(length: int) -> tuple[int, int]:
        left[length] -= 1
        if not left[length]:
            del left[length]
        return stock[length].pop()

    while left:
        top = max(left)
        left[top] -= 1
        chosen = fill(sorted((k for k in left if left[k] and k <= capacity - top), reverse=True), left, capacity - top)
        left[top] += 1
        chosen[top] += 1
        used = sum(k * n for k, n in chosen.items())
        if used < capacity - slack and sum(k * n for k, n in left.items()) > used:
            # Nothing fits any better: cut the longest remainder that is left.
            window = [(*take(k), k) for k in sorted(chosen, reverse=True) for _ in range(chosen[k])]
            longest = max(left)
            row, start = take(longest)
            head = min(capacity - used, longest)
            window.append((row, start, head))
            if longest > head:
                stock.setdefault(longest - head, []).append((row, start + head))
                left[longest - head] += 1
            yield window
            continue
        for _ in range(min(left[k] // n for k, n in chosen.items())):
            yield [(*take(k), k) for k in sorted(chosen, reverse=True) for _ in range(chosen[k])]


#: crc is set for whole windows, ids for remainders.
CUT = "doc_id long, row long, start long, doc_tokens long, crc long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def _cut(packing: Packing):
    """Whole windows with the crc32 of their ids, and at most one remainder with its ids per document."""
    width = packing.capacity * 4

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = Tokens(packing.vocabulary), packing.end.to_bytes(4, "little")
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = tokens.of(text.as_py()) + end
                for at in range(0, len(ids), width):
                    part = ids[at : at + width]
                    what = (zlib.crc32(part), None) if len(part) == width else (None, part)
                    out.append((doc_id.as_py(), row, at // 4, len(ids) // 4, *what))
                    row += 1
            kinds = [pa.int64()] * 5 + [pa.binary()]
            columns = zip(*out, strict=True) if out else [[]] * 6
            arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row", "start", "doc_tokens", "crc", "ids"])

    return cut


def _packed(packing: Packing):
    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row").reset_index(drop=True)
        ids = list(rows["ids"])
        lengths = np.array([len(x) // 4 for x in ids])
        out = []
        for number, window in enumerate(pack(lengths, packing.capacity, packing.slack)):
            offset = 0
            for row, start, length in window:
                part = ids[row][4 * start : 4 * (start + length)]
                out.append((row, start, length, zlib.crc32(part), (key[0] << 32) + number, offset))
                offset += length
        frame = pd.DataFrame(out, columns=["at", "from", "length", "ids_crc32", "sequence_id", "offset"])
        source = rows.iloc[frame["at"]].reset_index(drop=True)
        frame["doc_id"] = source["doc_id"].astype("Int64")
        frame["start"] = source["start"] + frame["from"]
        frame["doc_tokens"] = source["doc_tokens"]
        return frame[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return packed


def pack_documents(docs: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of ``docs`` is a document of its own, also with a null or repeated id. A null or empty text is
    the end token alone. Whole windows have odd sequence ids, filled windows even ones. Columns other than
    doc_id and text are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cut = materialize(rows.mapInArrow(_cut(packing), CUT), "packing-pieces")
    rest = cut.where("crc is null")
    buckets = max(1, -(-rest.count() // packing.bucket_rows))
    bucket = F.pmod(F.xxhash64("row"), F.lit(buckets)).alias("bucket")
    filled = rest.select(bucket, "doc_id", "row", "start", "doc_tokens", "ids")
    filled = filled.groupBy("bucket").applyInPandas(_packed(packing), PIECES)
    whole = cut.where("crc is not null").select(
        "doc_id", "start", F.lit(packing.capacity).cast("long").alias("length"), F.col("crc").alias("ids_crc32"),
        "doc_tokens", (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return whole.union(filled.withColumn("sequence_id", F.col("sequence_id") * 2))
