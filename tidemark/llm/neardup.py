"""Operator 9: near-duplicate documents by MinHash bands, odd sketches and exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import HASHED_BYTES, filled, join_few, text_bytes, text_slices
from tidemark.llm.components import components
from tidemark.llm.rolling import FOLDED, Hashed, mix, numbers, shingles, word_ranges
from tidemark.session import checkpointed

# 24 bands of 4 samples: a pair at a similarity of 0.85 meets in no band with a chance of 2e-8, one at 0.8 of 5e-6.
BANDS, ROWS = 24, 4
SKETCH_WORDS = 8
# Buckets up to this size compare all their members; larger ones go by hubs and blocks.
SMALL = 12
HUBS = 4
BLOCK, BLOCK_SHINGLES = 1000, 400_000
# Ids of up to so many documents may be broadcast to pick their texts.
PICKED = 1_000_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; one shingle for a text of fewer words, none without words."""
    hashed = Hashed(FOLDED[data])
    begin, end, text = word_ranges(data, offsets)
    words = mix(hashed.ranges(begin, end))
    values, of = shingles(words, text, width)
    n = len(offsets) - 1
    cuts = np.searchsorted(of, np.arange(n + 1))
    first = np.searchsorted(text, np.arange(n + 1))
    sets = []
    for i in range(n):
        if cuts[i] < cuts[i + 1]:
            sets.append(np.unique(values[cuts[i]: cuts[i + 1]]))
        elif first[i] < first[i + 1]:
            few = words[first[i]: first[i + 1]]
            order = np.arange(len(few), dtype=np.uint64)
            whole = mix(few + order * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) + np.uint64(len(few))
            sets.append(mix(np.array([whole], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


_FACTORS = numbers(BANDS * ROWS, 3) | np.uint64(1)
_BANDS = numbers(BANDS, 4)


def samples(values: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set that is not empty: the least product with each odd factor."""
    least = None
    for at in range(0, len(values), 2048):
        part = (values[at: at + 2048, None] * _FACTORS).min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def band_keys(sample: np.ndarray) -> np.ndarray:
    keys = _BANDS.copy()
    for part in sample.reshape(BANDS, ROWS).T:
        keys = mix(keys + part)
    return keys


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    """A bitmap of parities: each sample flips the bit that its number and value hash to."""
    bits = SKETCH_WORDS * 64
    places = (mix(sample + np.arange(len(sample), dtype=np.uint64)) % np.uint64(bits)).astype(np.int64)
    parity = np.bincount(places, minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view("<u8")


def sketch_limit(similarity: float) -> int:
    """Most differing sketch bits that a pair of that similarity can show, but for one chance in 10**9.

    Two sets differ in a binomial number of samples, six deviations at most; each flips two of the
    bits, and the XOR of two odd sketches with m flips holds n / 2 * (1 - exp(-2 m / n)) ones on average.
    """
    k, bits, apart = BANDS * ROWS, SKETCH_WORDS * 64, 1 - similarity
    flips = 2 * min(k, k * apart + 6 * math.sqrt(k * apart * similarity))
    mean = bits / 2 * (1 - math.exp(-2 * flips / bits))
    return math.ceil(min(flips, mean + 3 * math.sqrt(mean / 2)))


_SIGNED = "d bigint, g1 bigint, g2 bigint, n bigint, bands array<bigint>, sketch array<bigint>"


def signatures(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its id, a 128-bit digest of its shingle set, the set's size, band keys and odd sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch, "text")
            for begin, end in text_slices(texts, HASHED_BYTES):
                sets = shingle_sets(*text_bytes(texts.slice(begin, end - begin)), width)
                g1, g2, bands, sketches = [], [], [], []
                for values in sets:
                    spread = mix(values)
                    g1.append(int(spread.sum(dtype=np.uint64)))
                    g2.append(int(np.bitwise_xor.reduce(mix(spread + np.uint64(1)))) if len(values) else 0)
                    if len(values):
                        sample = samples(values)
                        bands.append(band_keys(sample).view(np.int64))
                        sketches.append(odd_sketch(sample).view(np.int64))
                    else:
                        bands.append(np.zeros(0, np.int64))
                        sketches.append(np.zeros(0, np.int64))
                lists = pa.list_(pa.int64())
                yield pa.record_batch(
                    [batch.column(0).slice(begin, end - begin), pa.array(np.array(g1, np.uint64).view(np.int64)),
                     pa.array(np.array(g2, np.uint64).view(np.int64)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(bands, lists), pa.array(sketches, lists)],
                    names=["d", "g1", "g2", "n", "bands", "sketch"])

    picked = docs.select(F.col(doc_id).cast("bigint").alias("d"), F.col(text).alias("text"))
    return picked.mapInArrow(run, _SIGNED)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch, "text")
            for begin, end in text_slices(texts, HASHED_BYTES):
                sets = shingle_sets(*text_bytes(texts.slice(begin, end - begin)), width)
                yield pa.record_batch([batch.column(0).slice(begin, end - begin),
                                       pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                                      names=["c", "items"])

    return docs.mapInArrow(run, "c bigint, items array<bigint>")


def _pairs(left: Column, right: Column) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _sized(a: Column, b: Column, similarity: float) -> Column:
    return F.least(a, b) >= F.greatest(a, b) * F.lit(similarity - 1e-9)


def enough(inter: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether 100 times the intersection is at least ``percent`` times the union."""
    return inter * 100 >= (a + b - inter) * percent


def _blocks(percent: int, limit: int):
    """Links of the left documents with the right ones of one block pair, one per left document and component."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        if len(left) and len(right):
            sets = [np.asarray(x).view(np.uint64) for x in right["items"]]
            sizes = np.array([len(s) for s in sets])
            comp, ids = right["comp"].to_numpy(), right["c"].to_numpy()
            sketch = np.stack([np.asarray(x).view(np.uint64) for x in right["sketch"]])
            bands = np.stack([np.asarray(x) for x in right["bands"]])
            for c, own, keys, bits, number, items in zip(left["c"], left["comp"], left["bands"], left["sketch"],
                                                         left["band"], left["items"]):
                values = np.asarray(items).view(np.uint64)
                apart = np.bitwise_count(sketch ^ np.asarray(bits).view(np.uint64)).sum(axis=1)
                # Each pair belongs to the first band in which it meets.
                earlier = (bands[:, :number] == np.asarray(keys)[:number]).any(axis=1)
                near = (np.minimum(sizes, len(values)) * 100 >= np.maximum(sizes, len(values)) * percent)
                todo = np.flatnonzero((comp != own) & ~earlier & near & (apart <= limit))
                if not len(todo):
                    continue
                joined = np.concatenate([sets[t] for t in todo])
                at = np.searchsorted(values, joined)
                hits = np.append(values, np.uint64(0))[at] == joined
                hits &= at < len(values)
                inter = np.add.reduceat(hits, np.append(0, np.cumsum(sizes[todo])[:-1]))
                linked = todo[inter * 100 >= (sizes[todo] + len(values) - inter) * percent]
                _, one = np.unique(comp[linked], return_index=True)
                out.extend((int(c), int(ids[t])) for t in linked[one])
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row.

    Rows are linked when 100 times the intersection of their sets of ``width``-word shingles is at least
    ``percent`` times the union; components are taken over all links.  Words are runs
    without ASCII white space, A-Z in lower case.  Rows with equal sets form one class, whose smallest id stands for it.
    Classes that agree in a band are candidates:

    * in a bucket of up to 12 all pairs of it,
    * in a larger one each member with the bucket's four hubs, the most central member of each of
      four hash slices (central: the sum of the sizes of all buckets that hold it); after
      their links are closed, members still apart from the main hub's component meet the bucket
      in blocks, once per pair, and yield one link per component.

    Candidates whose odd sketches differ too far are dropped (``sketch_limit``), all others are verified on
    full sets.  No pair that shares a band is left unchecked unless it is connected already.

    Texts without words (null too) have no shingles and link with nothing.  Rows that share an id
    are one document.  Rows without an id take no part: their component is null and they are
    not kept.  Extra columns are ignored; an empty table stays empty.
    """
    similarity = percent / 100
    limit = sketch_limit(similarity)
    signed = checkpointed(signatures(docs, width, doc_id, text), "signatures")
    whole = signed.filter("d is not null and n > 0")
    classes = checkpointed(whole.groupBy("g1", "g2", "n").agg(
        F.min("d").alias("c"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")), "classes")
    rows = classes.select("c", "n", F.posexplode("bands").alias("band", "key"))
    # Written before it is joined: a join straight on an aggregate cannot split a hot key.
    buckets = checkpointed(rows.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("total")).filter("m > 1"), "buckets")
    members = checkpointed(rows.join(buckets, "key"), "members")
    central = members.groupBy("c").agg(F.sum("m").alias("score"))
    small, large = members.filter(F.col("m") <= SMALL), members.filter(F.col("m") > SMALL)
    other = small.select("key", F.col("c").alias("c2"), F.col("n").alias("n2"))
    near = small.join(other, "key").filter((F.col("c") < F.col("c2")) & _sized(F.col("n"), F.col("n2"), similarity))
    scored = large.join(central, "c")
    hubs = (scored.groupBy("key", F.pmod(F.xxhash64("c"), F.lit(HUBS)).alias("slice"))
            .agg(F.max_by(F.struct("c", "n"), F.struct("score", F.negative("c"))).alias("hub"))
            .select("key", F.col("hub.c").alias("c2"), F.col("hub.n").alias("n2")))
    starred = large.join(hubs, "key").filter((F.col("c") != F.col("c2")) & _sized(F.col("n"), F.col("n2"), similarity))
    pairs = near.select(*_pairs(F.col("c"), F.col("c2"))).unionByName(
        starred.select(*_pairs(F.col("c"), F.col("c2")))).distinct()
    items = checkpointed(_member_sets(docs, members, width, doc_id, text), "sets")
    links = checkpointed(_verified(pairs, classes, items, percent, limit), "links")
    found = components(links)
    # What is left of the large buckets.
    scored = checkpointed(large.join(central, "c").join(found.withColumnRenamed("node", "c"), "c", "left")
                          .withColumn("comp", F.coalesce("root", "c")).drop("root"), "large")
    main = (scored.groupBy("key").agg(F.max_by("comp", F.struct("score", F.negative("c"))).alias("main"),
                                      F.min("comp").alias("least"), F.max("comp").alias("most"))
            .filter("least != most").select("key", "main"))
    apart = checkpointed(scored.join(main, "key"), "apart")
    if not apart.isEmpty():
        more = _block_links(apart, classes, items, percent, limit)
        links = checkpointed(links.unionByName(more), "links")
        found = components(links)
    labels = classes.select("g1", "g2", F.col("n").alias("_n"), "c").join(
        found.withColumnRenamed("node", "c"), "c", "left").select(
        F.col("g1").alias("_g1"), F.col("g2").alias("_g2"), "_n", F.coalesce("root", "c").alias("root"))
    joined = signed.select("d", "g1", "g2", "n").join(
        labels, (F.col("g1") == F.col("_g1")) & (F.col("g2") == F.col("_g2")) & (F.col("n") == F.col("_n")), "left")
    # Without words a document stands alone; without an id it stands nowhere.
    component = F.when(F.col("d").isNotNull(), F.coalesce("root", "d"))
    return joined.select(F.col("d").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(component == F.col("d"), F.lit(False)).alias("kept"))


def _member_sets(docs: DataFrame, members: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """Full shingle sets of the documents that share a bucket with another."""
    wanted = checkpointed(members.select("c").distinct(), "wanted")
    n = wanted.count()
    texts = docs.select(F.col(doc_id).cast("bigint").alias("c"), F.col(text).alias("text"))
    texts = texts.join(F.broadcast(wanted) if n <= PICKED else wanted, "c", "left_semi")
    return _sets(texts, width)


def _verified(pairs: DataFrame, classes: DataFrame, items: DataFrame, percent: int, limit: int) -> DataFrame:
    """The pairs whose sets are similar enough: odd sketches first, then whole sets."""
    one = classes.select(F.col("c").alias("a"), F.col("sketch").alias("sa"))
    two = classes.select(F.col("c").alias("b"), F.col("sketch").alias("sb"))
    apart = sum((F.bit_count(F.col("sa")[i].bitwiseXOR(F.col("sb")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    close = checkpointed(pairs.join(one, "a").join(two, "b").filter(apart <= limit).select("a", "b").distinct(), "pairs")
    inter = F.size(F.array_intersect("ia", "ib")).cast("bigint")
    sizes = F.size("ia").cast("bigint"), F.size("ib").cast("bigint")
    return (close.join(items.select(F.col("c").alias("b"), F.col("items").alias("ib")), "b")
            .join(items.select(F.col("c").alias("a"), F.col("items").alias("ia")), "a")
            .filter(enough(inter, *sizes, percent)).select("a", "b").distinct())


def _block_links(apart: DataFrame, classes: DataFrame, items: DataFrame, percent: int, limit: int) -> DataFrame:
    """Links of members that stand apart from their bucket's main component with all its members."""
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))
    full = (apart.withColumn("blocks", blocks)
            .join(classes.select("c", "bands", "sketch").dropDuplicates(["c"]), "c")
            .join(items.dropDuplicates(["c"]), "c"))
    slot = F.pmod(F.xxhash64("c"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    wanted = ["key", "lb", "rb", "c", "comp", "band", "bands", "sketch", "items"]
    left = full.filter("comp != main").withColumn("lb", slot).withColumn("rb", F.explode(every)).select(*wanted)
    # New column identities, as both sides come from one table.
    right = full.withColumn("rb", slot).withColumn("lb", F.explode(every)).select(*wanted).toDF(*wanted)
    return (left.groupBy("key", "lb", "rb").cogroup(right.groupBy("key", "lb", "rb"))
            .applyInPandas(_blocks(percent, limit), "a bigint, b bigint").distinct())


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that copy no row before them: one of each group of near copies, and all rows without words
    or without an id.

    Each different (id, text) is judged by its own shingles, so rows that share an id and differ in text
    do not stand for each other; of rows alike in both one stays, the last in the order of all columns by their hash.
    """
    same = (F.col("doc_id").cast("bigint") == F.col("id")) & (F.xxhash64("text") == F.col("h"))
    keys = checkpointed(docs.filter("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("id"),
                                                                 F.xxhash64("text").alias("h")).distinct(), "texts")
    if keys.groupBy("id").count().filter("count > 1").isEmpty():
        judged = checkpointed(near_duplicates(docs.select("doc_id", "text"), width, percent), "judged")
        gone = judged.filter("not kept and doc_id is not null").select("doc_id").distinct()
        kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    else:
        # Texts go by numbers of their own, in the order of ids, so that the smallest id of a group stays.
        numbered = checkpointed(_numbered(keys), "numbers")
        texts = docs.select("doc_id", "text").join(numbered, same).select(F.col("number").alias("doc_id"), "text")
        judged = checkpointed(near_duplicates(texts, width, percent), "judged")
        gone = numbered.join(judged.filter("not kept").select(F.col("doc_id").alias("number")).distinct(), "number", "left_semi")
        kept = docs.join(gone, same, "left_anti").select(*docs.columns)
    if docs.filter("doc_id is not null").count() == keys.count():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = (kept.filter("doc_id is not null").groupBy(F.col("doc_id").alias("key"), F.xxhash64("text").alias("text_key"))
           .agg(F.max_by(row, F.xxhash64(row)).alias("row")))
    return one.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]).unionByName(kept.filter("doc_id is null"))


def _numbered(keys: DataFrame) -> DataFrame:
    """``keys`` (id, h) with ``number``: 0, 1, ... in their order, counted within ranges of ids."""
    placed = checkpointed(keys.repartitionByRange("id", "h").sortWithinPartitions("id", "h")
                          .withColumn("place", F.monotonically_increasing_id()), "places")
    # A place has the partition's number in its upper bits and the row within it in the lower 33.
    parts = placed.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n"))
    # One row per partition, so this window stays small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return join_few(placed.withColumn("part", F.shiftright("place", 33)), begins, ["part"]).select(
        "id", "h", (F.col("begin") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("number"))
