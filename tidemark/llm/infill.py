"""Operator 12: fill-in-the-middle by displacement scatter.

A batch of texts is one run of bytes.  Every text is cut into prefix, middle and suffix at line ends; what the
transformation does to a byte is to move it by some shift, and the shift is constant between cuts.  So a scan finds the
cuts, a difference array holds the change of the shift at each, its cumulative sum gives every byte its shift, and one
scatter builds all outputs.  The inverse scans an output for its marks, builds the shifts of the restored bytes in the
same way, and gathers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import filled, text_bytes, text_slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
_STEP = 1 << 20
COLUMNS = "doc_id {id}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(doc_id: Column, seed: int = 7) -> list[Column]:
    """Four numbers of 32 bits from the sha256 of seed, colon and decimal id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def _marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a mark begins, and the number of its text."""
    if len(data) < MARK:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(data[:-2] == PREFIX[0])
    letter = data[at + 1]
    at = at[(data[at + 2] == PREFIX[2]) & ((letter == PREFIX[1]) | (letter == SUFFIX[1]) | (letter == MIDDLE[1]))]
    text = np.searchsorted(offsets, at, side="right") - 1
    inside = at + MARK <= offsets[text + 1]
    return at[inside], text[inside]


def _displaced(size: int, starts: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """For stretches of bytes the shift of each: ``shifts`` hold from ``starts`` (ascending) on.

    The difference array is dense for a stretch at a time, so a very long text costs no more memory than a stretch.
    """
    change = np.diff(shifts, prepend=0)
    carried = 0
    for begin in range(0, size, _STEP):
        end = min(size, begin + _STEP)
        a, b = np.searchsorted(starts, [begin, end])
        difference = np.zeros(end - begin, np.int64)
        np.add.at(difference, starts[a:b] - begin, change[a:b])
        difference[0] += carried
        shift = np.cumsum(difference)
        carried = int(shift[-1])
        yield begin, end, shift


def _strings(data: np.ndarray, offsets: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    valid = None
    if missing is not None and missing.any():
        valid = pa.py_buffer(np.packbits(~missing, bitorder="little").tobytes())
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data), valid)


def scatter(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray, kept: np.ndarray,
            suffix_first: np.ndarray):
    """Outputs of some texts: bytes, offsets, number of lines, plainness, and the two cuts of each.

    ``first`` and ``second`` pick the cuts, ``kept`` marks texts that stay plain whatever they hold.
    """
    starts, ends = offsets[:-1], offsets[1:]
    lines = np.flatnonzero(data == 10)
    before = np.searchsorted(lines, offsets)
    whole = np.diff(before)
    empty = starts == ends
    open_end = ~empty & (data[np.maximum(ends - 1, 0)] != 10) if len(data) else np.zeros(len(starts), bool)
    n = whole + open_end
    a, b = first % (n + 1), second % (n + 1)

    def cut(units: np.ndarray) -> np.ndarray:
        place = np.full(len(units), 0, np.int64)
        closed = (units > 0) & (units <= whole)
        place[closed] = lines[before[:-1][closed] + units[closed] - 1] + 1
        return np.where(units == 0, starts, np.where(closed, place, ends))

    one, two = cut(np.minimum(a, b)), cut(np.maximum(a, b))
    plain = empty | kept
    plain[_marks(data, offsets)[1]] = True
    out = np.concatenate([[0], np.cumsum(ends - starts + np.where(plain, 0, 3 * MARK))])
    base = out[:-1]
    prefix, suffix = one - starts, ends - two
    # Where prefix, middle and suffix of each text go.
    to_prefix = base + np.where(suffix_first, 2 * MARK + suffix, MARK)
    to_suffix = base + np.where(suffix_first, MARK, 2 * MARK + prefix)
    to_middle = base + 3 * MARK + prefix + suffix
    shifts = np.stack([np.where(plain, base - starts, to_prefix - starts), np.where(plain, base - starts, to_middle - one),
                       np.where(plain, base - starts, to_suffix - two)], axis=1).ravel()
    cuts = np.stack([starts, one, two], axis=1).ravel()
    result = np.zeros(int(out[-1]), np.uint8)
    for begin, end, shift in _displaced(len(data), cuts, shifts):
        result[np.arange(begin, end) + shift] = data[begin:end]
    for mark, place in ((PREFIX, to_prefix), (SUFFIX, to_suffix), (MIDDLE, to_middle)):
        at = place[~plain] - MARK
        for i in range(MARK):
            result[at + i] = mark[i]
    return result, out, n, plain, one, two


def gather(data: np.ndarray, offsets: np.ndarray, plain: np.ndarray, suffix_first: np.ndarray):
    """Texts from outputs and forms: bytes, offsets, and which outputs do not hold the three marks of their form."""
    starts, ends = offsets[:-1], offsets[1:]
    at, text = _marks(data, offsets)
    wrong = ~plain & (np.bincount(text, minlength=len(starts)) != 3)
    used = ~(plain | wrong)[text]
    three, of = at[used].reshape(-1, 3), text[used].reshape(-1, 3)[:, 0]
    late = suffix_first[of]
    at_prefix, at_suffix = np.where(late, three[:, 1], three[:, 0]), np.where(late, three[:, 0], three[:, 1])
    fits = ((three[:, 0] == starts[of]) & (data[at_prefix + 1] == PREFIX[1]) & (data[at_suffix + 1] == SUFFIX[1])
            & (data[three[:, 2] + 1] == MIDDLE[1]))
    wrong[of[~fits]] = True
    three, of, late, at_prefix, at_suffix = three[fits], of[fits], late[fits], at_prefix[fits], at_suffix[fits]
    prefix = np.where(late, three[:, 2], three[:, 1]) - at_prefix - MARK
    middle = ends[of] - three[:, 2] - MARK
    size = np.where(wrong, 0, ends - starts)
    size[of] -= 3 * MARK
    back = np.concatenate([[0], np.cumsum(size)])
    places = np.stack([back[:-1]] * 3, axis=1)
    places[of, 1] += prefix
    places[of, 2] += prefix + middle
    shifts = np.stack([starts - back[:-1]] * 3, axis=1)
    for column, source in ((0, at_prefix), (1, three[:, 2]), (2, at_suffix)):
        shifts[of, column] = source + MARK - places[of, column]
    result = np.zeros(int(back[-1]), np.uint8)
    for begin, end, shift in _displaced(len(result), places.ravel(), shifts.ravel()):
        result[begin:end] = data[np.arange(begin, end) + shift]
    return result, back, wrong


def _points(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[int]:
    """Code points of byte ranges."""
    return [int(np.count_nonzero((data[b:e] & 0xC0) != 0x80)) for b, e in zip(begin.tolist(), end.tolist())]


def fill_in_middle(docs: DataFrame, seed: int = 7, percent: int = 100, suffix_first_percent: int = 50,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    ``n`` counts the lines of the whole text; two draws of the id pick the cuts among the ``n + 1`` line ends.  The form is
    ``plain`` (output is the text) for empty texts, texts that hold a mark, and the share beyond ``percent``; of the others
    ``suffix_first_percent`` are ``spm``, the rest ``psm``.  Null texts count as empty, a null id draws as an empty one,
    repeated rows come out alike, an empty table stays empty and other columns are ignored.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                         *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col(doc_id), seed))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, h = filled(batch, "text"), [batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(4)]
            for begin, end in text_slices(texts):
                data, offsets = text_bytes(texts.slice(begin, end - begin))
                h1, h2, h3, h4 = (x[begin:end] for x in h)
                late = h4 % 100 < suffix_first_percent
                result, out, n, plain, one, two = scatter(data, offsets, h1, h2, h3 % 100 >= percent, late)
                form = np.where(plain, "plain", np.where(late, "spm", "psm"))
                yield pa.record_batch(
                    [batch.column(0).slice(begin, end - begin), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(_points(data, offsets[:-1], one), pa.int64(), mask=plain),
                     pa.array(_points(data, one, two), pa.int64(), mask=plain), _strings(result, out)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return picked.mapInArrow(run, COLUMNS.format(id=picked.schema["doc_id"].dataType.simpleString()))


def restore(outputs: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``outputs`` with a last column ``restored``: the text from output and form alone.

    Null where an output does not hold the three marks of its form once each.  A column of that name gives way.
    """
    names = [c for c in outputs.columns if c.lower() != "restored"]
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    picked = outputs.select(row.alias("row"))
    fields = [c.lower() for c in names]
    at_output, at_form = fields.index(output.lower()), fields.index(form.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column(0).flatten()
            texts = filled(pa.record_batch([columns[at_output]], names=["text"]), "text")
            forms = np.array(columns[at_form].to_pylist(), dtype=object)
            for begin, end in text_slices(texts):
                data, offsets = text_bytes(texts.slice(begin, end - begin))
                kind = forms[begin:end]
                result, back, wrong = gather(data, offsets, kind == "plain", kind == "spm")
                yield pa.record_batch([batch.column(0).slice(begin, end - begin), _strings(result, back, wrong)],
                                      names=["row", "restored"])

    schema = "row " + picked.schema["row"].dataType.simpleString() + ", restored string"
    return picked.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`").alias(c) for c in names], "restored")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``: both directions, as digests."""
    both = restore(fill_in_middle(docs))
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))
