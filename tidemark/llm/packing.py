"""Best-two-fit packing of token sequences.

Bins are filled greedily with the longest piece that fits; then a bin's smallest piece is replaced
by two unpacked pieces if these fit its expanded gap more tightly. Pieces of one length are
interchangeable, so the packing is planned on the histogram of lengths, which has no more entries
than a sequence has tokens: the driver plans bin patterns with multiplicities, and the pieces take
their places by their rank among the pieces of their length. Ranks come from counts per input
partition and length, so that no length is gathered in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, cut, documents, trimmed
from tidemark.llm.vocabulary import ByteEncoder, tokenizer_path

CAPACITY, END = 2048, 0


@lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str) -> ByteEncoder:
    return ByteEncoder(path, ranks_path)


def lengths_of(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens; all but the first are whole sequences."""
    pieces = -(-n // capacity)
    return [n - capacity * (pieces - 1), *[capacity] * (pieces - 1)] if pieces else []


def best_two_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Bin patterns: how many bins, and the lengths in each, for ``histogram[length]`` pieces."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan = []
    while left.any():
        free = left.copy()
        bin_, gap = [], capacity
        while gap and len(fits := np.flatnonzero(free[: gap + 1])):
            longest = int(fits[-1])
            take = min(int(free[longest]), gap // longest)
            bin_ += [longest] * take
            free[longest] -= take
            gap -= longest * take
        if gap and len(bin_) > 1:
            room = gap + bin_[-1]
            # The longest free length up to each length, and with it the best partner for each.
            upto = np.maximum.accumulate(np.where(free[: room + 1] > 0, np.arange(room + 1), 0))
            first = np.flatnonzero(free[: room + 1])
            second = upto[room - first]
            alone = (second == first) & (free[first] < 2)
            below = upto[np.maximum(first - 1, 0)]
            second = np.where(alone, np.where(below < first, below, 0), second)
            both = np.where(second > 0, first + second, 0)
            if len(both) and int(both.max()) > bin_[-1]:
                k = int(both.argmax())
                bin_ = [*bin_[:-1], *sorted((int(first[k]), int(second[k])), reverse=True)]
        used = np.bincount(bin_, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= used * times
        plan.append((times, bin_))
    return plan


def places(plan: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows of length, first rank, pieces of that length in a bin, first sequence, first offset; sorted."""
    rows, ranks, sequence = [], {}, 0
    for times, bin_ in plan:
        offset = 0
        for length in dict.fromkeys(bin_):
            n = bin_.count(length)
            rows.append((length, ranks.get(length, 0), n, sequence, offset))
            ranks[length] = ranks.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces_of(df: DataFrame, path: str, ranks_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with their crc32, the partition that made them, and their rank there among those of their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, part = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()  # type: ignore[union-attr]
        names = ["_row", "piece", "start", "length", "ids_crc32", "_nth"]
        for batch in batches:
            for at, ids, bounds in encoder(path, ranks_path).encode(batch.column(1)):
                out: list[tuple[int, ...]] = []
                for i, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    own, start = np.append(ids[low:high], np.uint32(END)), 0
                    for k, n in enumerate(lengths_of(len(own), capacity)):
                        out.append((at + i, k, start, n, zlib.crc32(own[start : start + n].astype("<u4").tobytes()), int(seen[n])))
                        seen[n] += 1
                        start += n
                del ids, bounds
                columns = [pa.array(np.array(c, np.int64)) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(columns[0]), columns[1].cast(pa.int32()), *columns[2:], pa.array(np.full(len(out), part, np.int64))], ["_id", *names[1:], "_part"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    return rows.mapInArrow(trimmed(run), f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, _nth bigint, _part bigint")


def pack(df: DataFrame, path: str, ranks_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and one end id, so null and empty texts are one token. Only documents of
    more than ``capacity`` tokens are cut; all their pieces but the first fill a sequence. The id
    passes through, null and repeated ones included; other columns play no part. An empty table
    gives an empty result.
    """
    with bounded_batches(df.sparkSession):
        pieces = cut(pieces_of(df, path, ranks_path, capacity, id_col, text_col))
    counts = pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    table = places(best_two_fit(histogram, capacity))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")
    ranked = pieces.join(counts.select("_part", "length", before.alias("_before")), ["_part", "length"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = (table[:, 0] << 45) | table[:, 1]
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            row = table[np.searchsorted(first, (length << 45) | rank, "right") - 1]
            turn = rank - row[:, 1]
            sequence, offset = row[:, 3] + turn // row[:, 2], row[:, 4] + turn % row[:, 2] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = ranked.select("_id", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_nth")).alias("_rank"))
    out = rows.mapInArrow(trimmed(run), f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
    return out.withColumnRenamed("_id", id_col)


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))


QUERIES = {"op7_packing": op7_packing}
SQL: dict[str, str] = {}
