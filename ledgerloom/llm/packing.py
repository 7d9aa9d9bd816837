"""Best-fit packing of tokenised documents into sequences of one length.

The plan is made on the histogram of piece lengths, which has at most ``capacity``
entries however many documents there are; pieces then take the planned slots by
joining on their rank within their length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import ranked_within, written
from ledgerloom.llm.tokens import encoder, tokenizer_path

CAPACITY = 2048
END_OF_TEXT = 0

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def plan_slots(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit-decreasing over counts: ``(length, first_rank, last_rank, sequence, offset)``.

    Pieces of one length are alike, and so are sequences with the same room left, so
    both are handled as runs: a run of k sequences takes k pieces at once. The pieces
    ranked ``first_rank`` to ``last_rank`` of a length go to consecutive sequences from
    ``sequence`` on, all at ``offset``. A run is divided at most once per length and
    moves at most ``capacity`` places, so the plan's size depends on ``capacity``
    alone, not on the counts.
    """
    runs: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    slots: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def leave(room: int, first: int, number: int) -> None:
        if room not in runs:
            runs[room] = []
            bisect.insort(rooms, room)
        runs[room].append((first, number))

    for length in sorted((n for n, c in counts.items() if c > 0), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit a sequence of {capacity}")
        rank, left = 1, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
            else:
                # As many new sequences as the rest needs when each is filled up with it.
                room, first, number = capacity, opened, -(-left // (capacity // length))
                opened += number
            taken = min(number, left)
            if taken < number:
                leave(room, first + taken, number - taken)
            slots.append((length, rank, rank + taken - 1, first, capacity - room))
            if room > length:
                leave(room - length, first, taken)
            rank, left = rank + taken, left - taken
    return slots


SLOT_SCHEMA = T.StructType(
    [
        T.StructField("slot_length", T.LongType()),
        T.StructField("first_rank", T.LongType()),
        T.StructField("last_rank", T.LongType()),
        T.StructField("first_sequence", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


def tokenised_pieces(docs: DataFrame, capacity: int, tokenizer: str) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; only a document's first may be shorter."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
            ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ]
    )
    end = np.array([END_OF_TEXT], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            rows: list[tuple] = []
            for doc_id, text in zip(ids, texts, strict=True):
                data = memoryview(tokens.ids(text.as_py() or "").tobytes() + end)
                total = len(data) // 4
                first = total % capacity or min(total, capacity)
                bounds = [0, *range(first, total + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(data[4 * a:4 * b])))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE_SCHEMA)


def pack(
    spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None
) -> DataFrame:
    """``PIECE_SCHEMA`` and ``sequence_id``, ``offset`` for every piece of ``docs``.

    Takes ``doc_id`` and ``text`` and ignores other columns. A null text is empty and
    so one token, the end mark; null and repeated ids are packed as rows of their own;
    no rows give no rows. Pieces of equal length rank by id, piece and checksum.
    """
    pieces = written(
        tokenised_pieces(docs, capacity, tokenizer or tokenizer_path()), "packing-pieces"
    )
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(plan_slots(histogram, capacity), SLOT_SCHEMA)
    ranked = ranked_within(pieces, "length", ["doc_id", "piece", "ids_crc32"], "packing-ranks")
    fits = (
        (F.col("length") == F.col("slot_length"))
        & (F.col("row_rank") >= F.col("first_rank"))
        & (F.col("row_rank") <= F.col("last_rank"))
    )
    # The plan's size is bounded by the capacity alone (see plan_slots), so it is broadcast.
    return ranked.join(F.broadcast(slots), fits).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.col("row_rank") - F.col("first_rank")).alias("sequence_id"),
        "offset",
    )
