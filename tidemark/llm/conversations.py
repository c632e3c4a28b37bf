"""Operator 13: conversation structure repair.

Conversations of up to ``ROWS`` turns are sorted together by one shuffle and repaired one at a time.  Longer ones are cut:
their turns are ranged over tasks, each stretch of turns yields its best edits between all states of the role grammar, and only
these are put together per conversation.  Repaired turns never meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import audits
from tidemark.llm.common import join_few
from tidemark.session import checkpointed

ROWS = 4096
BLANKS = " \t\n\r\x0b\x0c"
ENDS = ".!?"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPAIRED = "array<struct<role: string, text: string>>"
# Repaired conversations leave a task in batches of about so many characters.
_BATCH = 1 << 21


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows changed by crc32(``conv_id:turn``) modulo 20, nulls read as one space.

    0 takes the row away (it stays as a mark that the conversation exists), 1 empties the text, 2 removes its ``.!?``, 3
    repeats the row, 4 makes its role user.
    """
    def told(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = (F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace(told("text"), "[.!?]", ""))
            .otherwise(told("text")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.select("conv_id", "turn", "role", "text", kind.alias("kind"))
            .select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                    F.when(F.col("kind") == 4, F.lit("user")).otherwise(told("role")).alias("role"), text.alias("text"),
                    (F.col("kind") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy"))


def _faults(turns: list[tuple], seen: list[bool] | None = None) -> str:
    """A letter per (turn, role, text): blank ``b``, duplicate ``d``, truncated ``t``, else ``-``.

    ``seen`` tells which turns repeat an earlier one, where the conversation is not whole.
    """
    out, earlier = [], set()
    for i, (_, role, text) in enumerate(turns):
        end = text.rstrip(BLANKS)
        known = (role, text) in earlier if seen is None else seen[i]
        out.append("b" if not end else "d" if known else "-" if end[-1] in ENDS else "t")
        if seen is None:
            earlier.add((role, text))
    return "".join(out)


def _judged(faults: str) -> str:
    return faults.replace("b", "x").replace("d", "x")


def _initials(turns: list[tuple]) -> str:
    """The first character of each role; an empty role has one that no rule knows."""
    return "".join(role[:1] or " " for _, role, _ in turns)


def _illegal(initials: str) -> int:
    return sum(a + b not in audits.LEGAL for a, b in zip(initials, initials[1:]))


def _spans(batches: Iterator[pa.RecordBatch], key: str = "conv_id"):
    """Sorted rows of all batches as (key, iterator of row dicts), one batch in memory at a time."""
    return groupby((row for batch in batches for row in batch.to_pylist()), key=itemgetter(key))


def _batched(rows: Iterator[tuple[dict, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row, weight in rows:
        held.append(row)
        size += weight
        if size >= _BATCH:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


_PAIRS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
# Ascending order puts nulls first.
_SORTED = ("conv_id", "turn", "role", "text")


def _short(rows: DataFrame) -> DataFrame:
    """Repairs of conversations of at most ``ROWS`` turns; marks (``gone``) hold no turn."""
    key = _arrow(rows, "conv_id")
    schema = pa.schema([("conv_id", key), ("piece", pa.int32()), ("pieces", pa.int32()), *[(c, pa.int64()) for c in COUNTS],
                        ("audit", pa.string()), ("repaired", _PAIRS)])

    def repaired(batches):
        for conv_id, group in _spans(batches):
            turns = [(r["turn"], r["role"], r["text"]) for r in group if not r["gone"]]
            faults, initials = _faults(turns), _initials(turns)
            cost, audit = audits.best(_judged(faults), initials)
            dated = [t for t, _, _ in turns if t is not None]
            gaps = max(dated) - min(dated) + 1 - len(set(dated)) if dated else 0
            new = audits.apply(audit, [t[1:] for t in turns])
            yield ({"conv_id": conv_id, "piece": 0, "pieces": 1, "gaps": gaps, "blank": faults.count("b"),
                    "duplicate": faults.count("d"), "truncated": faults.count("t"), "illegal": _illegal(initials),
                    "cost": cost, "audit": audit, "repaired": [{"role": a, "text": b} for a, b in new]},
                   sum(len(b) + 40 for _, b in new) + 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(repaired(batches), schema)

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return (rows.repartition("conv_id").sortWithinPartitions(*_SORTED).mapInArrow(
        run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, piece int, pieces int, {counts}, audit string, "
             f"repaired {_REPAIRED}"))


def _cut(rows: DataFrame) -> DataFrame:
    """Stretches of at most ``ROWS`` turns of long conversations, with their best edits between all states."""
    key = _arrow(rows, "conv_id")
    options = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    numbers = ("blank", "duplicate", "truncated", "illegal", "turns")
    schema = pa.schema([("conv_id", key), ("first", pa.int64()), ("last", pa.int64()), ("least", pa.int64()), ("opening", pa.string()),
                        ("closing", pa.string()), *[(c, pa.int64()) for c in numbers], ("options", options),
                        ("before", _PAIRS), ("place", pa.int64())])

    def stretch(conv_id, held: list[dict]) -> tuple[dict, int]:
        turns = [(r["turn"], r["role"], r["text"]) for r in held]
        faults, initials = _faults(turns, [r["seen"] for r in held]), _initials(turns)
        dated = [t for t, _, _ in turns if t is not None]
        found = audits.paths(_judged(faults), initials)
        return ({"conv_id": conv_id, "first": turns[0][0], "last": turns[-1][0], "least": dated[0] if dated else None,
                 "opening": initials[0], "closing": initials[-1],
                 "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
                 "illegal": _illegal(initials), "turns": len(set(dated)),
                 "options": [{"begin": a, "end": b, "cost": c, "audit": e} for (a, b), (c, e) in found.items()],
                 "before": [{"role": r, "text": t} for _, r, t in turns], "place": held[0]["place"]},
                sum(len(t) + 60 for _, _, t in turns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stretches():
            for conv_id, group in _spans(batches):
                held: list[dict] = []
                for row in group:
                    held.append(row)
                    if len(held) == ROWS:
                        yield stretch(conv_id, held)
                        held = []
                if held:
                    yield stretch(conv_id, held)

        yield from _batched(stretches(), schema)

    order = [*_SORTED, "n"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    return placed.mapInArrow(
        run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, first bigint, last bigint, least bigint, opening string, "
             "closing string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, "
             f"options array<struct<begin: int, end: int, cost: bigint, audit: string>>, before {_REPAIRED}, place bigint")


def _chosen(stretches: DataFrame) -> DataFrame:
    """``place, piece, pieces, begin, audit`` per stretch and the counts of each conversation with its first.

    A conversation's stretches arrive in order; what is held of them is a letter per turn and state, as the
    conversation's own list of edits is no shorter.
    """
    schema = pa.schema([("place", pa.int64()), ("piece", pa.int32()), ("pieces", pa.int32()),
                        *[(c, pa.int64()) for c in COUNTS], ("begin", pa.int32()), ("audit", pa.string())])

    def conversation(group):
        # For each state the best way there: cost, edits, and per stretch the state it begins in.
        ways: dict[int, tuple[int, str, list[int], list[int]]] = {audits.START: (0, "", [], [])}
        places, sums, last, least, closing, turns = [], dict.fromkeys(COUNTS, 0), None, None, None, 0
        for row in group:
            new: dict[int, tuple] = {}
            for o in row["options"]:
                if o["begin"] in ways:
                    cost, edits, states, ends = ways[o["begin"]]
                    whole = (cost + o["cost"], edits + o["audit"], [*states, o["begin"]], [*ends, len(edits) + len(o["audit"])])
                    if o["end"] not in new or whole[:2] < new[o["end"]][:2]:
                        new[o["end"]] = whole
            ways = new
            places.append(row["place"])
            for c in ("blank", "duplicate", "truncated", "illegal"):
                sums[c] += row[c]
            sums["illegal"] += closing is not None and closing + row["opening"] not in audits.LEGAL
            turns += row["turns"] - (last is not None and last == row["least"])
            least = row["least"] if least is None else least
            last = row["last"] if row["last"] is not None else last
            closing = row["closing"]
        cost, edits, states, ends = min(ways[b] for b in audits.ACCEPTED if b in ways)
        sums |= {"gaps": last - least + 1 - turns if least is not None else 0, "cost": cost}
        for i, (place, begin, stop) in enumerate(zip(places, states, ends)):
            yield {"place": place, "piece": i, "pieces": len(places), "begin": begin, "audit": edits[ends[i - 1] if i else 0: stop],
                   **(sums if i == 0 else dict.fromkeys(COUNTS, 0))}, stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched((out for _, group in _spans(batches) for out in conversation(group)), schema)

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    narrow = stretches.drop("before")
    return (narrow.repartition("conv_id").sortWithinPartitions("conv_id", "place")
            .mapInArrow(run, f"place bigint, piece int, pieces int, {counts}, begin int, audit string"))


def _long(rows: DataFrame) -> DataFrame:
    """Repairs of long conversations, a row per stretch of turns."""
    numbered = checkpointed(rows.drop("gone").withColumn("n", F.monotonically_increasing_id()), "long-turns")
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    same = F.sha2(F.concat_ws(":", F.col("conv_id").isNull().cast("string"), F.length(conv), F.length("role"), conv, "role",
                              "text").cast("binary"), 256)
    keyed = numbered.withColumn("same", same)
    first = checkpointed(keyed.groupBy("same").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn", "n"))["n"].alias("first_n")),
                         "first-turns")
    flagged = keyed.join(first, "same").withColumn("seen", F.col("n") != F.col("first_n")).drop("same", "first_n")
    stretches = checkpointed(_cut(flagged), "stretches")
    chosen = checkpointed(_chosen(stretches), "chosen")
    whole = stretches.select("conv_id", "place", "before").join(chosen, "place")
    schema = pa.schema([("conv_id", _arrow(rows, "conv_id")), ("piece", pa.int32()), ("pieces", pa.int32()),
                        *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired", _PAIRS)])

    def repaired(batches):
        for row in (r for batch in batches for r in batch.to_pylist()):
            new = audits.apply(row["audit"], [(t["role"], t["text"]) for t in row.pop("before")], row.pop("begin"))
            del row["place"]
            yield row | {"repaired": [{"role": a, "text": b} for a, b in new]}, sum(len(b) + 40 for _, b in new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(repaired(batches), schema)

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return whole.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, piece int, pieces int, {counts}, "
                                 f"audit string, repaired {_REPAIRED}")


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, piece, pieces, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired``.

    ``rows`` has ``conv_id, turn, role, text`` and, if some rows only mark that their conversation exists, a boolean ``gone``;
    other columns are ignored.  Turns go by ``turn`` (nulls first), equal ones by role and text.  A conversation of up to ``ROWS`` turns is
    one piece, a longer one several, whose audits and lists of repaired turns follow one another; its counts stand at
    piece 0.  Rows without a ``conv_id`` are one conversation; null roles and texts are read as one space; an empty role fits no
    rule.  Without turns all counts are 0.  An empty table stays empty.
    """
    marked = dict(rows.dtypes).get("gone") == "boolean"
    told = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.coalesce("gone", F.lit(False)) if marked else F.lit(False)).alias("gone"))
    present = told.filter(~F.col("gone"))
    marks = told.filter("gone").select("conv_id").distinct().select(
        "conv_id", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(True).alias("gone"))
    large = checkpointed(present.groupBy("conv_id").count().filter(F.col("count") > ROWS).select(F.col("conv_id").alias("large")),
                         "long-conversations")
    if large.isEmpty():
        return _short(present.unionByName(marks))
    is_large = F.col("conv_id").eqNullSafe(F.col("large"))
    few = join_few(present.unionByName(marks), large, is_large, "left_anti")
    return _short(few).unionByName(_long(join_few(present, large, is_large, "left_semi")))


def digests(repairs: DataFrame) -> DataFrame:
    """A row per conversation with its counts, whole ``audit``, and ``repaired_sha256`` of its ``role:text`` lines.

    The text of a conversation in pieces is hashed piece by piece, in order, and never put together.
    """
    lines = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    one = repairs.filter("pieces = 1").select("conv_id", *COUNTS, "audit", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
    schema = pa.schema([("conv_id", _arrow(repairs, "conv_id")), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def hashed(batches):
        for conv_id, group in _spans(batches):
            digest, audit, sums, begun = hashlib.sha256(), [], dict.fromkeys(COUNTS, 0), False
            for row in group:
                for t in row["repaired"]:
                    digest.update((("\n" if begun else "") + t["role"] + ":" + t["text"]).encode())
                    begun = True
                audit.append(row["audit"])
                sums = {c: sums[c] + row[c] for c in COUNTS}
            yield {"conv_id": conv_id, **sums, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}, 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(hashed(batches), schema)

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    many = (repairs.filter("pieces > 1").repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(
        run, f"conv_id {repairs.schema['conv_id'].dataType.simpleString()}, {counts}, audit string, repaired_sha256 string"))
    return one.unionByName(many)


def audit_damaged(rows: DataFrame) -> DataFrame:
    """Damage, repair and digest of a table of conversations."""
    return digests(checkpointed(repair(damage(rows)), "repairs"))
