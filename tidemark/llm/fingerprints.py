"""Operator 8: fingerprints by consistent weighted sampling, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import WORD
from tidemark.session import checkpointed

# Samples are drawn in blocks: a row for each block of a term, a column for each sample of a block.  Few columns
# keep the generated method short enough for the JVM to compile it.
BLOCKS, PER_BLOCK = 32, 2
SAMPLES = BLOCKS * PER_BLOCK
# Keys hold the size of a sample as a fixed-point number with 24 bits behind the point, in 31 bits.
_ONE, _ZERO, _TOP = float(1 << 24), 64.0, (1 << 31) - 1
_LOW = (1 << 32) - 1
BLANK = r"[\x20\x09-\x0D]+"


def _gamma_quantile(p: float) -> float:
    """Where the distribution function 1 - (1 + x) exp(-x) of Gamma(2, 1) is ``p``."""
    low, high = 0.0, 60.0
    for _ in range(80):
        x = (low + high) / 2
        low, high = (x, high) if 1 - (1 + x) * math.exp(-x) < p else (low, x)
    return (low + high) / 2


# Quantiles at the bounds of equal parts; the last bound stands for the tail beyond it.
_CELL_BITS = 9
_CELLS = 1 << _CELL_BITS
_QUANTILES = [_gamma_quantile(min(i / _CELLS, 1 - 2.0 ** -12)) for i in range(_CELLS + 1)]
_LOGS = [math.log(max(q, 1e-9)) for q in _QUANTILES]


def _bits(source: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(source, shift).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _looked_up(table: list[float], number: Column, width: int) -> Column:
    """The table's function at ``number`` / 2**width, linear between its bounds."""
    cell, rest = F.shiftrightunsigned(number, width - _CELL_BITS).cast("int"), width - _CELL_BITS
    within = (number.bitwiseAND(F.lit((1 << rest) - 1).cast("bigint")).cast("double") + F.lit(0.5)) * F.lit(2.0 ** -rest)
    steps = [b - a for a, b in zip(table, table[1:])]
    return F.get(F.lit(table[:-1]), cell) + within * F.get(F.lit(steps), cell)


def draws(term: str, block: str) -> dict[str, Column]:
    """``h`` (a hash of its own), ``r``, ``logc`` and ``b`` of each sample of a block for a term.

    ``r`` is drawn from Gamma(2, 1), ``logc`` is the logarithm of another such draw, and ``b`` is uniform.  Both
    come from quantile tables, as logarithms cost most; only the lowest 64th of ``logc``, where the least bids lie,
    comes from the series of the inverse, c = x + x**2 / 3 + 11 x**3 / 72 + ... with x = sqrt(2 p).
    """
    found = {}
    for j in range(PER_BLOCK):
        h = F.xxhash64(F.col(term), F.col(block) * PER_BLOCK + j)
        low = _bits(h, 20, 28)
        x = F.sqrt((low.cast("double") + F.lit(0.5)) * F.lit(2.0 ** -27))
        series = F.ln(x * (F.lit(1.0) + x * (F.lit(1 / 3) + x * F.lit(11 / 72))))
        found[f"h{j}"] = h
        found[f"r{j}"] = _looked_up(_QUANTILES, _bits(h, 0, 20), 20)
        found[f"logc{j}"] = F.when(low < F.lit(1 << 22), series).otherwise(_looked_up(_LOGS, low, 28))
        found[f"b{j}"] = (_bits(h, 48, 16).cast("double") + F.lit(0.5)) * F.lit(2.0 ** -16)
    return found


def sample_key(j: int, log_weight: Column) -> Column:
    """What a term bids for sample ``j`` of its block; the least bid of a set is its sample.

    With t = floor(ln w / r + b) the bid's size is ln a = ln c - r (t - b + 1), and the sample is (term, t).
    The high 31 bits hold the size, the low 32 bits a name of (term, t), equal for equal samples.
    """
    t = F.floor(log_weight / F.col(f"r{j}") + F.col(f"b{j}"))
    size = F.col(f"logc{j}") - F.col(f"r{j}") * (t - F.col(f"b{j}") + F.lit(1.0))
    fixed = F.least(F.greatest(((size + F.lit(_ZERO)) * F.lit(_ONE)).cast("bigint"), F.lit(0).cast("bigint")),
                    F.lit(_TOP).cast("bigint"))
    name = F.xxhash64(F.col(f"h{j}"), t).bitwiseAND(F.lit(_LOW).cast("bigint"))
    # least and greatest pass over nulls, so a term without a weight is left out here.
    return F.when(log_weight.isNotNull(), F.shiftleft(fixed, 32).bitwiseOR(name))


def signatures(terms: DataFrame, keys: list[str], weights: list[str]) -> DataFrame:
    """``keys`` and an array of sample names for each weight column of ``keys, term, <weights>``.

    ``term`` is a hash; a weight of 0 or null leaves a term out of that set.  An array is all null for an
    empty set.  Two sets agree in each sample with a chance of their generalised Jaccard similarity.
    """
    blocked = terms.withColumn("block", F.explode(F.lit(list(range(BLOCKS)))))
    logs = [F.ln(F.when(F.col(w) > 0, F.col(w))).alias(f"log_{w}") for w in weights]
    drawn = blocked.select(*keys, "block", *logs, *[c.alias(name) for name, c in draws("term", "block").items()])
    head = weights[0]
    bids = [sample_key(j, F.col(f"log_{head}")).alias(f"{head}_{j}") for j in range(PER_BLOCK)]
    first = drawn.select("*", *bids)
    least = [F.min(f"{head}_{j}").alias(f"{head}_{j}") for j in range(PER_BLOCK)]
    for w in weights[1:]:
        # An equal weight makes an equal bid.
        same = F.col(f"log_{w}") == F.col(f"log_{head}")
        least += [F.min(F.when(same, F.col(f"{head}_{j}")).otherwise(sample_key(j, F.col(f"log_{w}")))).alias(f"{w}_{j}")
                  for j in range(PER_BLOCK)]
    made = first.groupBy(*keys, "block").agg(*least)
    names = {w: F.array(*[(F.col(f"{w}_{j}").bitwiseAND(F.lit(_LOW).cast("bigint")) - F.lit(1 << 31)).cast("int")
                          for j in range(PER_BLOCK)]) for w in weights}
    whole = made.select(*keys, F.struct("block", *[c.alias(w) for w, c in names.items()]).alias("part"))
    listed = whole.groupBy(*keys).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return listed.select(*keys, *[F.flatten(F.col(f"parts.{w}")).alias(w) for w in weights])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; 1 for two empty sets, 0 if one is empty."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    empty_a, empty_b = a[0].isNull(), b[0].isNull()
    return F.when(empty_a & empty_b, 1.0).when(empty_a | empty_b, 0.0).otherwise(equal / F.lit(float(SAMPLES)))


def as_text(names: Column) -> Column:
    """A signature as 8 hex digits per sample; empty for the empty set."""
    digits = F.transform(names, lambda x: F.lpad(F.hex(x.cast("bigint") + F.lit(1 << 31)), 8, "0"))
    return F.when(names[0].isNull(), F.lit("")).otherwise(F.array_join(digits, ""))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole.alias("text")).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("k1"),
        F.xxhash64(F.col("doc_id").isNull(), "text").alias("k2"))


def successors(keyed: DataFrame) -> DataFrame:
    """``k1, k2, doc_id, n, m, next1, next2``: each different row, its length and copies, and the next row's key.

    Rows are in ascending order of id (null first), then of the text's hash; the first follows the last.  Narrow rows are
    dealt by range and sorted there; only the first row of each range meets those of the others.
    """
    own = ["doc_id", "k1", "k2", "n"]
    different = keyed.groupBy("doc_id", "k1", "k2", F.length("text").cast("bigint").alias("n")).agg(F.count("*").alias("m"))
    ranged = checkpointed(
        different.repartitionByRange("doc_id", "k2").sortWithinPartitions("doc_id", "k2")
        .select(*own, "m", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "order")
    heads = ranged.groupBy("part").agg(F.min_by(F.struct("k1", "k2"), "place").alias("head"))
    ring = Window.orderBy("part")
    following = heads.select("part", F.coalesce(F.lead("head").over(ring), F.first("head").over(ring)).alias("head"))
    inside = F.lead(F.struct("k1", "k2")).over(Window.partitionBy("part").orderBy("place"))
    # One row per range: as many as partitions.
    linked = ranged.withColumn("next", inside).join(F.broadcast(following), "part")
    after = F.coalesce("next", "head")
    return linked.select(*own, "m", after["k1"].alias("next1"), after["k2"].alias("next2"))


def _words(text: Column) -> Column:
    return F.split(text, BLANK)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    A document's terms are its words (runs without ASCII white space), weighted by how often they occur.
    The edited text has the last quarter of the code points replaced by the first as many (or
    all) of the next document, in ascending order of id.  Both versions share their
    beginning, so its words are exploded once and each term's draws serve both weights.

    Null texts are empty; texts without words have the empty fingerprint, alike to each other (1)
    and to nothing else (0).  Null ids come first.  Rows alike in id and text are one document in the order, and each
    yields its row; of rows with one id the text's hash decides.  Other columns are ignored; an empty table stays empty.
    """
    keyed = _keyed(docs, doc_id, text)
    chain = checkpointed(successors(keyed), "chain")
    quarter = F.floor(F.col("n") / 4)
    wanted = chain.select(F.col("next1").alias("k1"), F.col("next2").alias("k2"), F.col("k1").alias("to1"),
                          F.col("k2").alias("to2"), quarter.alias("take"))
    texts = keyed.select("k1", "k2", "text")
    heads = (texts.join(wanted, ["k1", "k2"])
             .select(F.col("to1").alias("k1"), F.col("to2").alias("k2"), F.expr("left(text, int(take))").alias("head")))
    heads = heads.dropDuplicates(["k1", "k2"])
    both = (texts.join(chain.select("k1", "k2", "n", "m"), ["k1", "k2"]).join(heads, ["k1", "k2"])
            .withColumn("begin", F.expr("left(text, int(n - floor(n / 4)))")))
    both = both.withColumn("edited", F.concat("begin", "head")).withColumn(
        "shared", F.length(F.regexp_replace("begin", WORD + r"\z", "")))
    parts = both.select("k1", "k2", "m", F.explode(F.array(
        F.struct(F.lit(1).alias("a"), F.lit(1).alias("b"), F.expr("left(begin, shared)").alias("part")),
        F.struct(F.lit(1).alias("a"), F.lit(0).alias("b"), F.expr("substring(text, shared + 1)").alias("part")),
        F.struct(F.lit(0).alias("a"), F.lit(1).alias("b"), F.expr("substring(edited, shared + 1)").alias("part")))).alias("p"))
    words = parts.select("k1", "k2", "m", "p.a", "p.b", F.explode(_words(F.col("p.part"))).alias("word")).filter("word != ''")
    counted = words.groupBy("k1", "k2", F.xxhash64("word").alias("term")).agg(
        (F.sum("a") / F.min("m")).alias("a"), (F.sum("b") / F.min("m")).alias("b"))
    signed = signatures(counted, ["k1", "k2"], ["a", "b"])
    hashes = both.groupBy("k1", "k2").agg(F.min(F.sha2(F.col("edited").cast("binary"), 256)).alias("edited_sha256"))
    nothing = F.array_repeat(F.lit(None).cast("int"), SAMPLES)
    made = checkpointed(
        hashes.join(signed, ["k1", "k2"], "left").select(
            "k1", "k2", "edited_sha256", F.coalesce("a", nothing).alias("a"), F.coalesce("b", nothing).alias("b")), "signed")
    after = made.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.col("a").alias("next"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m")))
    return (chain.join(made, ["k1", "k2"]).join(after, ["next1", "next2"])
            .withColumn("copy", copies)
            .select("doc_id", F.col("n").alias("n_chars"), "edited_sha256", as_text(F.col("a")).alias("fingerprint"),
                    as_text(F.col("b")).alias("edited_fingerprint"), likeness(F.col("a"), F.col("b")).alias("near_edited"),
                    likeness(F.col("a"), F.col("next")).alias("near_next")))
