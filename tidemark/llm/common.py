"""Small helpers that several operators of this folder share."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A table of at most this many narrow rows may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 100_000
# Words are runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package from where the driver has it."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def replaced(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns``; a column of the same name (in any case) gives way."""
    taken = {c.lower() for c in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken],
                     *[expr.alias(name) for name, expr in columns.items()])


def join_few(left: DataFrame, few: DataFrame, condition: Column | Sequence[str], how: str = "inner",
             rows: int | None = None) -> DataFrame:
    """Join a table that is usually small: broadcast after a look at its size, else a plain join."""
    n = few.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return left.join(F.broadcast(few) if n <= BROADCAST_ROWS else few, condition, how)


def parts_for(rows: int, per_part: int) -> int:
    return max(1, -(-rows // per_part))


# Bytes of text that are hashed at a time: each takes some fifty while its hashes are made.
HASHED_BYTES = 1 << 20


def text_slices(texts: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer single text is a range of its own."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset: texts.offset + len(texts) + 1]
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, int(offsets[begin]) + most, side="right")) - 1)
        yield begin, min(end, len(texts))
        begin = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without nulls, and where each text begins and ends."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset: texts.offset + len(texts) + 1]
    if len(offsets) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[int(offsets[0]): int(offsets[-1])]
    return data, offsets.astype(np.int64) - int(offsets[0])


def filled(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A text column, null as empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    if texts.type != pa.string():
        texts = texts.cast(pa.string())
    return texts.fill_null("") if texts.null_count else texts


def text_of_rows(rows: pa.StructArray, at: int) -> pa.Array:
    """The text column number ``at`` of whole rows, null as empty; so that texts enter a worker once."""
    return filled(pa.record_batch([rows.flatten()[at]], names=["text"]), "text")


# Bytes of lists that may be broadcast to join documents; larger lists are shuffled with the documents.
BROADCAST_BYTES = 64 << 20


def join_documents(docs: DataFrame, lists: DataFrame, how: str, item_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """Join documents (``d`` id, ``h`` hash of the text) with a ``list`` per document.

    The lists are broadcast after a look at their size, else (beyond ``most`` bytes) shuffled with the documents.
    """
    size = lists.agg(F.sum(F.size("list") * item_bytes + 64)).first()[0] or 0
    few = lists.select(F.col("d").alias("_d"), F.col("h").alias("_h"), "list")
    return docs.join(F.broadcast(few) if size <= most else few,
                     F.col("d").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), how).drop("_d", "_h")
