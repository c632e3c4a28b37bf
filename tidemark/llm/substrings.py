"""Operator 10: exact removal of repeated byte strings with suffix arrays built by linear grouping.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.  Three steps
keep this exact while no task sees more than its share:

1. Every window of ``length`` bytes has one anchor, the k-byte string in it with the smallest hash
   (the leftmost of equals).  Equal windows have equal anchors at equal places, so each document
   falls into segments, the runs of windows with one anchor, and only segments with equal
   anchors can hold equal windows.  Anchors that occur once leave here.
2. A whole segment that occurs twice is repeated in all its windows.  That settles nearly
   everything, common passages included, with partial counts.
3. Different segments around one anchor (where a repeated passage begins or ends) meet in
   shards.  A shard joins their bytes, with the anchor as one symbol, into one string, sorts its suffixes
   by linear grouping (``grouping.suffix_array``) and marks windows whose common prefix with
   a neighbour in suffix order spans them.  An anchor with very many different segments is split over
   blocks; each block's distinct windows are then matched across blocks by their hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import HASHED_BYTES, filled, join_documents, parts_for, text_bytes, text_slices
from tidemark.llm.grouping import common_prefixes, suffix_array
from tidemark.llm.rolling import BYTE, Hashed, least_runs, numbers
from tidemark.session import checkpointed

_ANCHORS = "k bigint, s bigint, d bigint, h bigint, at bigint"
_SEGMENTS = "k bigint, s bigint, n bigint, u bigint, d bigint, h bigint, at bigint, bytes binary"
_MARKS = "d bigint, h bigint, begin bigint, end bigint, w1 bigint, w2 bigint"
# Different segments around one anchor that one shard takes; more are split.
GROUP = 8192
SHARD = 1500
_OTHER = numbers(256, 7)


def _pack(lo: np.ndarray, windows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return (lo.astype(np.int64) << 24) | (windows.astype(np.int64) << 12) | anchor.astype(np.int64)


def _unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 24, (at >> 12) & 4095, at & 4095


def segments_of(data: np.ndarray, offsets: np.ndarray, length: int, k: int, keys_only: bool = False):
    """Text number, anchor hash, segment hash, start in the text, windows, and place of the anchor, per segment;
    the anchor hash alone with ``keys_only``."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64) if keys_only else (none, none.view(np.uint64), none.view(np.uint64), none, none, none)
    hashed = Hashed(BYTE[data])
    grams = hashed.grams(k)
    of, lo, windows, (place,) = least_runs([grams], length - k + 1, offsets, length)
    if keys_only:
        return grams[place]
    return of, grams[place], hashed.ranges(lo, lo + windows + length - 1), lo - offsets[of], windows, place - lo


def _anchors(docs: DataFrame, length: int, k: int, keys_only: bool = False) -> DataFrame:
    """The segments of all texts; ``keys_only`` gives the column ``k`` alone, at less cost."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch, "text")
            ids, hashes = batch.column(0), batch.column(1)
            for begin, end in text_slices(texts, HASHED_BYTES):
                if keys_only:
                    grams = segments_of(*text_bytes(texts.slice(begin, end - begin)), length, k, True)
                    yield pa.record_batch([pa.array(grams.view(np.int64))], names=["k"])
                    continue
                of, grams, whole, lo, windows, place = segments_of(*text_bytes(texts.slice(begin, end - begin)), length, k)
                rows = pa.array(of + begin)
                yield pa.record_batch(
                    [pa.array(grams.view(np.int64)), pa.array(whole.view(np.int64)), ids.take(rows), hashes.take(rows),
                     pa.array(_pack(lo, windows, place))], names=["k", "s", "d", "h", "at"])

    return docs.mapInArrow(run, "k bigint" if keys_only else _ANCHORS)


def _extents(context: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each row, the longest prefix that it shares with another row of its group; 0 ends a row."""
    rows = np.concatenate([group.astype(">u8")[:, None].view(np.uint8).reshape(len(group), 8),
                           context.astype(">u2").view(np.uint8).reshape(len(group), -1)], axis=1)
    order = np.argsort(np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel())
    context, group = context[order], group[order]
    equal = (context[1:] == context[:-1]) & (context[1:] > 0) & (group[1:] == group[:-1])[:, None]
    shared = np.where(equal.all(axis=1), context.shape[1], np.argmin(equal, axis=1))
    longest = np.zeros(len(order), np.int64)
    longest[order[1:]] = shared
    longest[order[:-1]] = np.maximum(longest[order[:-1]], shared)
    return longest


def _marked(strings: list[tuple[int, bytes, bytes]], extra: int) -> list[np.ndarray]:
    """For each (group, left bytes, right bytes): the left lengths of its windows, as flags, that occur in another.

    ``extra`` is what a window has besides its anchor.  Window ``x`` starts ``x`` bytes into the left part.
    """
    names: dict[int, int] = {}
    symbols: list[int] = []
    starts = []
    for group, left, right in strings:
        starts.append(len(symbols))
        symbols.extend(left)
        symbols.append(256 + names.setdefault(group, len(names)))
        symbols.extend(right)
        symbols.append(-1)
    order = suffix_array(symbols)
    shared = np.asarray(common_prefixes(symbols, order), dtype=np.int64)
    ranked = np.asarray(order, dtype=np.int64)
    reach = np.zeros(len(symbols), np.int64)
    reach[ranked] = shared
    reach[ranked[:-1]] = np.maximum(reach[ranked[:-1]], shared[1:])
    return [reach[at: at + len(left) + 1] >= extra + 1 for at, (_, left, _) in zip(starts, strings)]


def _spans(flags: np.ndarray, first: int, length: int) -> Iterator[tuple[int, int]]:
    """Byte spans of runs of marked windows."""
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):
        yield first + x, first + y - 1 + length


def _matched(length: int, k: int):
    extra = length - k

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        split = rows["salt"].to_numpy() >= 0
        lo, windows, anchor = _unpack(rows["at"].to_numpy(np.int64))
        group, once = rows["k"].to_numpy(np.int64), rows["n"].to_numpy() == 1
        right = windows + length - 1 - anchor - k
        texts = rows["bytes"].to_list()
        joined = np.frombuffer(b"".join(texts) + bytes(length), np.uint8)
        begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64)
        middle, columns = begin + anchor, np.arange(extra)
        after = np.where(columns < right[:, None], joined[np.minimum(middle[:, None] + k + columns, len(joined) - 1)].astype(np.uint16) + 1, 0)
        before = np.where(columns < anchor[:, None], joined[np.maximum(middle[:, None] - 1 - columns, 0)].astype(np.uint16) + 1, 0)
        # Only bytes that some other segment shares can be in a repeated window; where blocks are
        # matched later, all are kept.
        lefts = np.where(split, anchor, _extents(before, group))
        rights = np.where(split, right, _extents(after, group))
        kinds: dict[tuple[int, bytes, bytes], list[int]] = {}
        for i in np.flatnonzero(lefts + rights >= extra).tolist():
            text, a = texts[i], int(anchor[i])
            key = (int(group[i]), text[a - lefts[i]: a], text[a + k: a + k + rights[i]])
            kinds.setdefault(key, []).append(i)
        strings = list(kinds)
        out: list[tuple] = []
        ids, hashes = rows["d"].tolist(), rows["h"].tolist()
        for (key, members), flags in zip(kinds.items(), _marked(strings, extra)):
            most = len(key[1]) + len(key[2]) - extra + 1
            flags = flags[:most] | (len(members) > 1)
            for i in members:
                if once[i]:
                    first = int(lo[i] + anchor[i] - lefts[i])
                    out.extend((ids[i], hashes[i], x, y, None, None) for x, y in _spans(flags, first, length))
            i = members[0]
            if split[i]:
                data = np.frombuffer(texts[i], np.uint8)
                one, two = Hashed(BYTE[data]), Hashed(_OTHER[data])
                x = np.arange(most)
                h1, h2 = (t.ranges(x, x + length).view(np.int64).tolist() for t in (one, two))
                for x, hit in enumerate(flags.tolist()):
                    own = (ids[i], hashes[i], int(lo[i]) + x) if once[i] and not hit else (None, None, None)
                    out.append((*own, None, h1[x], h2[x]))
        columns = list(zip(*out)) if out else [()] * 6
        return pd.DataFrame({c: pd.array(v, "Int64") for c, v in zip(("d", "h", "begin", "end", "w1", "w2"), columns)})

    return run


def _cut_out(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch, "text")
            rows: list[tuple] = []
            for d, h, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts,
                                          batch.column(3).to_pylist()):
                data = text.as_buffer().to_pybytes()
                for w in wanted:
                    lo, windows = w["at"] >> 24, (w["at"] >> 12) & 4095
                    rows.append((w["k"], w["s"], w["n"], w["u"], d, h, w["at"], data[lo: lo + windows + length - 1]))
            columns = list(zip(*rows)) or [()] * 8
            yield pa.record_batch([pa.array(c, pa.binary() if i == 7 else pa.int64()) for i, c in enumerate(columns)],
                                  names=["k", "s", "n", "u", "d", "h", "at", "bytes"])

    return run


def _merge_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [[x for span in _merged(spans) for x in span] for spans in batch.column(2).to_pylist()]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))],
                              names=["d", "h", "list"])


def repeated_spans(keyed: DataFrame, length: int = 200, k: int = 100, group: int = GROUP) -> DataFrame:
    """``d, h, list``: per document with repeats the begin and end of each of its maximal repeated runs, in a row.

    ``keyed`` has ``d`` (id), ``h`` (hash of the text) and ``text``.  Rows alike in id and text are
    copies of one another, so their spans are the same.
    """
    if not 0 < k <= length or length > 4000:
        raise ValueError("k must be within the length, and the length at most 4000")
    anchors = _anchors(keyed, length, k)
    # Lists of keys are written before they are joined: a join straight on an aggregate cannot split a hot key.
    keys = checkpointed(
        _anchors(keyed, length, k, keys_only=True).groupBy("k").agg(F.count("*").alias("c")).filter("c > 1").select("k"), "keys")
    shared = checkpointed(anchors.join(keys, "k"), "anchors")
    segments = checkpointed(
        shared.groupBy("k", "s").agg(F.count("*").alias("n"), F.min(F.struct("d", "h", "at")).alias("one")), "segments")
    lo, windows = F.shiftright("at", 24), F.shiftright("at", 12).bitwiseAND(F.lit(4095))
    whole = (
        shared.join(segments.filter("n > 1").select("k", "s"), ["k", "s"])
        .select("d", "h", lo.alias("begin"), (lo + windows + F.lit(length - 1)).alias("end")))
    groups = checkpointed(segments.groupBy("k").agg(F.count("*").alias("u")).filter("u > 1"), "groups")
    mixed = segments.join(groups, "k").select("k", "s", "n", "u", "one.*")
    lists = checkpointed(mixed.groupBy("d", "h").agg(F.collect_list(F.struct("k", "s", "n", "u", "at")).alias("list")),
                         "wanted")
    texts = checkpointed(join_documents(keyed, lists, "inner", 48).select("d", "h", "text", "list")
                         .mapInArrow(_cut_out(length), _SEGMENTS), "texts")
    n = texts.count()
    blocks = F.ceil(F.col("u") / group)
    salt = F.when(F.col("u") > group, F.pmod(F.xxhash64("s"), blocks)).otherwise(F.lit(-1))
    shard = F.when(F.col("u") > group, F.xxhash64("k", salt)).otherwise(
        F.pmod(F.xxhash64("k"), F.lit(parts_for(n, SHARD))))
    marks = checkpointed(
        texts.dropDuplicates(["k", "s"]).withColumn("salt", salt).withColumn("shard", shard)
        .groupBy("shard").applyInPandas(_matched(length, k), _MARKS), "marks")
    across = (
        marks.filter("w1 is not null").groupBy("w1", "w2")
        .agg(F.count("*").alias("c"), F.collect_list(F.when(F.col("begin").isNotNull(), F.struct("d", "h", "begin"))).alias("own"))
        .filter("c > 1").select(F.explode("own").alias("o")).select("o.d", "o.h", "o.begin", (F.col("o.begin") + length).alias("end")))
    spans = whole.unionByName(marks.filter("end is not null").select("d", "h", "begin", "end")).unionByName(across)
    listed = spans.groupBy("d", "h").agg(F.collect_set(F.struct("begin", "end")).alias("list"))
    return listed.mapInArrow(_merge_lists, "d bigint, h bigint, list array<bigint>")


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


_CUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _cut(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            kept_bytes: list[bytes] = []
            spans_of = batch.column(batch.schema.get_field_index("list")).to_pylist()
            ids = batch.column(batch.schema.get_field_index("d")).to_pylist()
            for d, text, spans in zip(ids, filled(batch, "text"), spans_of):
                data, at, parts = text.as_buffer().to_pybytes(), 0, []
                spans = spans or []
                for begin, end in zip(spans[::2], spans[1::2]):
                    parts.append(data[at: begin])
                    at = end
                parts.append(data[at:])
                kept = b"".join(parts)
                rows.append((d, len(data), len(data) - len(kept), len(spans) // 2, hashlib.sha256(kept).hexdigest()))
                if keep:
                    kept_bytes.append(kept)
            columns = list(zip(*rows)) or [()] * 5
            arrays = [pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(columns)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep:
                arrays.append(pa.array(kept_bytes, pa.binary()))
                names.append("kept")
            yield pa.record_batch(arrays, names=names)

    return run


def remove_repeats(docs: DataFrame, length: int = 200, k: int = 100, doc_id: str = "doc_id", text: str = "text",
                   keep: bool = False, group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row; with ``keep`` also the remaining bytes.

    A null text is empty, a null id stays null, texts shorter than ``length`` keep everything,
    repeated rows are copies of each other and lose all of a text of ``length`` bytes and more.  Other
    columns, whatever their names, are not looked at.  An empty table stays empty.
    """
    keyed = docs.select(F.col(doc_id).cast("bigint").alias("d"), F.xxhash64(F.col(text)).alias("h"),
                        F.col(text).alias("text"))
    spans = checkpointed(repeated_spans(keyed, length, k, group), "spans")
    return join_documents(keyed, spans, "left", 8).mapInArrow(_cut(keep), _CUT + (", kept binary" if keep else ""))
