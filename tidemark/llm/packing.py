"""Operator 7: best-fit packing with certified bin counts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import filled, parts_for
from tidemark.llm.tokens import encoder
from tidemark.session import checkpointed

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"
_ROUND = PACKED + ", part bigint, filled bigint, bins bigint, bound bigint"
PER_PART = 65_536
ROUNDS = 4


def pieces(docs: DataFrame, path: str, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text",
           end: int = 0) -> DataFrame:
    """One row per piece of a document's ids (its text's, then ``end``).

    Only documents of over ``capacity`` ids are cut.  A null or empty text is the end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = encoder(path), np.uint32(end).tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for key, t in zip(batch.column(0).to_pylist(), filled(batch, "text")):
                ids = memoryview(encode(t.as_buffer().to_pybytes()) + tail)
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at: at + 4 * capacity]
                    rows.append((key, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32"])

    picked = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length: longest first, each into the fullest bin that still takes it.

    Open bins are kept by free space; a bit mask of the spaces in use finds the tightest one
    with a shift and the lowest set bit.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, opened = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = used >> need
        if fits:
            space = need + (fits & -fits).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                used ^= 1 << space
        else:
            space, b = capacity, opened
            opened += 1
        bins[i], offsets[i] = b, capacity - space
        left = space - need
        if not by_space[left]:
            used |= 1 << left
        by_space[left].append(b)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by dual-feasible functions.

    A dual-feasible function maps lengths to weights such that no set that fits into a bin
    weighs over one.  Tried are the plain share of the bin, the threshold family (lengths up
    to t count nothing, those over capacity - t a whole bin) for each t, and the rounding
    family floor((k + 1) x) / k for k to 100.
    """
    if len(lengths) == 0:
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((counts * size).sum()) // capacity)
    number, total = np.cumsum(counts), np.cumsum(counts * size)
    t = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - t]
    middle = total[capacity - t] - total[t - 1]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    for k in range(1, 101):
        scaled = (k + 1) * size
        # An exact multiple keeps its own value, all others round down.
        weight = np.where(scaled % capacity == 0, size * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((counts * weight).sum()) // (k * capacity)))
    return best


def _pack(capacity: int, turn: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy(np.int64)
        order = np.lexsort((rows["ids_crc32"], rows["piece"], rows["doc_id"].fillna(-1), -lengths))
        rows, lengths = rows.iloc[order], lengths[order]
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fills = np.bincount(bins, weights=lengths).astype(np.int64)
        part = int(rows["part"].iloc[0])
        return rows.assign(sequence_id=(turn << 56) + (part << 28) + bins, offset=offsets, filled=fills[bins],
                           bins=len(fills), bound=lower_bound(lengths, capacity))[
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "part", "filled", "bins",
             "bound"]]

    return run


def pack(items: DataFrame, capacity: int = 2048, per_part: int = PER_PART, rounds: int = ROUNDS) -> DataFrame:
    """Place pieces into sequences of at most ``capacity`` ids; adds ``sequence_id, offset``.

    Pieces are dealt evenly to parts of about ``per_part`` rows.  Each part packs its own by
    best-fit decreasing and certifies the count of its bins by ``lower_bound``.  The pieces in
    the bins that are not full, of the parts whose count stays over the bound and of one
    more bin in each other part (where rounding hides a gap), are exchanged: dealt to fewer
    parts and packed again, until no part has a gap, one part is left or ``rounds`` are over.
    A round that needs more bins than before is dropped.  Pieces of a full bin, and lone
    pieces of full length, are settled at once.
    """
    columns = PACKED.replace(" bigint", "").replace(" int", "").split(", ")
    n = items.count()
    todo, settled, turn = items, [], 0
    while True:
        parts = parts_for(n, per_part)
        # The number of the row, too, as rows may be alike; written pieces are read in the same order again.
        row = F.monotonically_increasing_id()
        spread = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", row, F.lit(turn)), F.lit(parts))
        packed = checkpointed(
            todo.select("doc_id", "piece", "start", "length", "ids_crc32", spread.alias("part"))
            .groupBy("part").applyInPandas(_pack(capacity, turn), _ROUND), "packing")
        if settled:
            before = before_bins
            after = packed.agg(F.countDistinct("sequence_id")).first()[0]
            if after >= before:
                settled.append(exchanged.select(*columns))
                break
        gap = F.col("bins") > F.col("bound")
        # The emptiest bin of a certified part, a bin a part, carries the rounding of its bound.
        lowest = packed.groupBy("part").agg(F.min(F.struct("filled", "sequence_id")).alias("least"))
        marked = packed.join(F.broadcast(lowest), "part").withColumn(
            "_again", (F.col("filled") < capacity) & (gap | (F.col("sequence_id") == F.col("least.sequence_id"))))
        turn += 1
        if parts == 1 or turn == rounds:
            settled.append(packed.select(*columns))
            break
        settled.append(marked.filter(~F.col("_again")).select(*columns))
        exchanged = marked.filter("_again").drop("_again", "least")
        n, before_bins = exchanged.agg(F.count("*"), F.countDistinct("sequence_id")).first()
        if n == 0:
            break
        todo = exchanged
    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    return result


def best_fit(docs: DataFrame, path: str, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text",
             per_part: int = PER_PART) -> DataFrame:
    """Cut, encode and pack documents: one row per piece with its place.

    Null texts are empty (one end id), repeated rows are packed as often as they occur, a null
    id stays null, and an empty table gives no rows.
    """
    items = checkpointed(pieces(docs, path, capacity, doc_id, text), "pieces")
    return pack(items, capacity, per_part)
