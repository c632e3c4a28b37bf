"""Operator 11: quality rules from a tokenizer's fertility.

A public vocabulary encodes a text's words; characters per token, the share of byte-fallback tokens and the entropy of
the token distribution say how much the text looks like the language that the vocabulary knows.  Each language (script,
where the language is unknown or rare) and length class has a band of usual values, measured on all documents that pass
the base rules; documents outside of a band are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import filled, join_few, text_bytes, text_slices
from tidemark.session import checkpointed

# A band is the median with so many robust deviations below and above, and at least this share of the median (a share of
# 0.05 of all tokens for byte fallback).  Two languages in one text raise the entropy and rare words the length of tokens, so there
# is more room above.
BELOW, ABOVE, LEAST_WIDTH, LEAST_FALLBACK = 3.5, 8.0, 0.04, 0.05
# A language or script has a band of its own in a length class from so many different documents on.
BAND_DOCUMENTS = 50
LEAST_WORDS, REPEATED_PERCENT = 50, 50
# Values are counted in steps of this size, so that quartiles come from exact counts.
STEPS = {"chars_per_token": 0.005, "fallback_share": 0.001, "token_entropy": 0.01}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True

# Scripts by the first byte of their letters in UTF-8.
SCRIPTS = ("none", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "kana", "han", "hangul")
_SCRIPT = np.zeros(256, np.uint8)
for _name, _ranges in (("latin", ((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9))), ("greek", ((0xCE, 0xCF),)),
                       ("cyrillic", ((0xD0, 0xD4),)), ("hebrew", ((0xD6, 0xD7),)), ("arabic", ((0xD8, 0xDB),)),
                       ("indic", ((0xE0, 0xE0),)), ("kana", ((0xE3, 0xE3),)), ("han", ((0xE4, 0xE9),)),
                       ("hangul", ((0xEA, 0xED),))):
    for _low, _high in _ranges:
        _SCRIPT[_low: _high + 1] = SCRIPTS.index(_name)


class WordTokens:
    """The ids of words under a sentencepiece vocabulary.

    A piece never spans white space, so a text's ids, its white space taken as single blanks, are its words' ids in a row.
    """

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self._model.get_piece_size()
        self.fallback = np.array([self._model.is_byte(i) for i in range(self.size)])

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids of all in a row."""
        lists = self._model.encode([w.decode("utf-8", "replace") for w in words], num_threads=1) if words else []
        length = np.fromiter(map(len, lists), np.int64, len(lists))
        return length, np.fromiter(chain.from_iterable(lists), np.int64, int(length.sum()))


class _Numbers(dict):
    """A number for each different word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


_models: dict[str, WordTokens] = {}


def _model(path: str) -> WordTokens:
    if path not in _models:
        _models[path] = WordTokens(path)
    return _models[path]


def _summed(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the flags each text has."""
    at = np.flatnonzero(flags)
    return np.diff(np.searchsorted(at, offsets))


def _repeated(ids: np.ndarray, kinds: int, doc: np.ndarray) -> np.ndarray:
    """Which words lie in a window of three words that their text holds twice or more."""
    covered = np.zeros(len(ids), bool)
    at = np.flatnonzero(doc[2:] == doc[:-2]) if len(ids) > 2 else np.zeros(0, np.int64)
    if len(at) == 0:
        return covered
    pair = ids[at] * kinds + ids[at + 1]
    if kinds >= 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    key = pair * kinds + ids[at + 2]
    order = np.argsort(key, kind="stable")
    key, of = key[order], doc[at][order]
    same = np.flatnonzero((key[1:] == key[:-1]) & (of[1:] == of[:-1]))
    hits = at[np.union1d(order[same], order[same + 1])]
    for i in range(3):
        covered[hits + i] = True
    return covered


def measure(tokens: WordTokens, texts: list[bytes], data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts and token measures of some texts (``texts`` and ``data`` hold the same bytes)."""
    n = len(texts)
    words: list[bytes] = []
    count = np.zeros(n, np.int64)
    dup = np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        found = t.split()
        count[i] = len(found)
        words += found
        if b"\n" in t:
            lines = [x for x in t.split(b"\n") if x and not x.isspace()]
            dup[i] = len(lines) - len(set(lines))
    index = _Numbers()
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    doc = np.repeat(np.arange(n), count)
    repeated = np.bincount(doc[_repeated(ids, len(index), doc)], minlength=n)
    del words
    length, flat = tokens.encode(list(index))
    first = np.cumsum(length) - length
    per_word = length[ids]
    n_tokens = np.bincount(doc, weights=per_word, minlength=n).astype(np.int64)
    ends = np.cumsum(per_word)
    total = int(ends[-1]) if len(ends) else 0
    token = flat[np.arange(total) + np.repeat(first[ids] - ends + per_word, per_word)]
    of = np.repeat(doc, per_word)
    fallback = np.bincount(of[tokens.fallback[token]], minlength=n)
    key, times = np.unique(of * tokens.size + token, return_counts=True)
    weighted = np.bincount(key // tokens.size, weights=times * np.log2(times), minlength=n)
    some = np.maximum(n_tokens, 1)
    chars = _summed((data & 0xC0) != 0x80, offsets) - _summed(_BLANK[data], offsets)
    scripts = np.stack([_summed(_SCRIPT[data] == k, offsets) for k in range(1, len(SCRIPTS))], axis=1)
    script = np.where(scripts.max(axis=1) > 0, scripts.argmax(axis=1) + 1, 0)
    return {
        "n_words": count, "word_chars": chars, "n_symbols": _summed(_SYMBOL[data], offsets), "n_dup_lines": dup,
        "n_repeat_words": repeated, "n_tokens": n_tokens, "chars_per_token": chars / some, "fallback_share": fallback / some,
        "token_entropy": np.log2(some) - weighted / some, "script": np.array(SCRIPTS)[script]}


COLUMNS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "n_tokens bigint, chars_per_token double, fallback_share double, token_entropy double, script string")


def measures(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``doc_id, lang`` and the counts and measures of every whole text; null texts count as empty.

    Characters per token leave white space out; entropy is in bits; ``script`` is that of most letters.  Without words
    all are 0 and the script is ``none``.
    """
    given = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    picked = docs.select(F.col(doc_id).alias("doc_id"), given.alias("lang"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _model(path)
        for batch in batches:
            texts = filled(batch, "text")
            for begin, end in text_slices(texts):
                part = texts.slice(begin, end - begin)
                data, offsets = text_bytes(part)
                found = measure(tokens, [t.as_buffer().to_pybytes() for t in part], data, offsets)
                yield pa.record_batch(
                    [batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin),
                     *[pa.array(v) for v in found.values()]], names=["doc_id", "lang", *found])

    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, lang string, {COLUMNS}")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


def _class() -> Column:
    """Texts of between two powers of two words are alike in length."""
    return F.floor(F.log2(F.greatest("n_words", F.lit(1)))).cast("int")


def bands(measured: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """``kind, name, size_class, documents`` and, per measure, ``<measure>_low`` and ``<measure>_high``.

    ``kind`` is ``lang`` or ``script``.  Only documents that pass the base rules count, alike ones (in length and all
    measures) once, so that copies do not move a band.  Quartiles come from exact counts of values in steps; what is shuffled
    is one narrow row per different document and then counts.  A group too small for a band has none.
    """
    rows = (measured.filter(~base_failed()).select("lang", "script", _class().alias("size_class"), "n_words", "word_chars",
                                                   "n_tokens", *STEPS).dropDuplicates())
    groups = F.array(F.struct(F.lit("lang").alias("kind"), F.col("lang").alias("name")),
                     F.struct(F.lit("script").alias("kind"), F.col("script").alias("name")))
    values = F.array(*[F.struct(F.lit(m).alias("measure"), F.round(F.col(m) / step).cast("bigint").alias("value"))
                       for m, step in STEPS.items()])
    counted = (rows.select(F.explode(groups).alias("g"), "size_class", values.alias("values"))
               .filter("g.name is not null").select("g.*", "size_class", F.explode("values").alias("v"))
               .groupBy("kind", "name", "size_class", "v.measure", "v.value").agg(F.count("*").alias("c")))
    group = Window.partitionBy("kind", "name", "size_class", "measure")
    placed = counted.select("*", F.sum("c").over(group).alias("n"),
                            F.sum("c").over(group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    quartiles = (placed.filter(F.col("n") >= BAND_DOCUMENTS).groupBy("kind", "name", "size_class", "measure").agg(
        F.max("n").alias("n"), *[F.min(F.when(F.col("upto") * 4 >= F.col("n") * k, F.col("value"))).alias(f"q{k}") for k in (1, 2, 3)]))
    # The quartiles of a normal distribution are 1.349 deviations apart; values are known to a step.
    deviation = (F.col("q3") - F.col("q1") + 1) / 1.349
    least = F.when(F.col("measure") == "fallback_share", LEAST_FALLBACK / STEPS["fallback_share"]).otherwise(LEAST_WIDTH * F.col("q2"))
    down, up = (F.greatest(F.lit(k) * deviation, least) for k in (below, above))
    sides = []
    for m, step in STEPS.items():
        here = F.col("measure") == m
        sides += [F.max(F.when(here, (F.col("q2") - down) * step)).alias(f"{m}_low"),
                  F.max(F.when(here, (F.col("q2") + up) * step)).alias(f"{m}_high")]
    return quartiles.groupBy("kind", "name", "size_class").agg(F.max("n").alias("documents"), *sides)


def _outside(side: str) -> Column:
    """Whether a row leaves a band; the share of byte fallback only upwards."""
    limits = {m: F.col(f"{side}.{m}_low") for m in STEPS if m != "fallback_share"}
    inside = [F.col(m) >= low for m, low in limits.items()] + [F.col(m) <= F.col(f"{side}.{m}_high") for m in STEPS]
    return ~reduce(and_, inside)


def judge(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``doc_id``, base counts, ``base_failed, kept`` and the token measures for every row of ``docs``.

    A row is kept if it passes the base rules and no measure leaves the band of its language and length, or of its
    script and length where the language has none; without either band it is kept.  Null texts and texts without words
    fail the base rules; a null language counts as unknown; repeated rows fare alike; other columns are ignored; an empty table
    stays empty.
    """
    measured = checkpointed(measures(docs, path, doc_id, text, lang), "measures")
    known = checkpointed(bands(measured), "bands")
    limits = F.struct(*[f"{m}_{side}" for m in STEPS for side in ("low", "high")])
    rows = measured.withColumn("size_class", _class())
    for kind, column in (("lang", "lang"), ("script", "script")):
        these = known.filter(F.col("kind") == kind).select(F.col("name").alias(column), "size_class", limits.alias(f"by_{kind}"))
        rows = join_few(rows, these, [column, "size_class"], "left")
    judged = rows.select("*", F.coalesce("by_lang", "by_script").alias("band"))
    reject = F.when(F.col("band").isNull(), F.lit(False)).otherwise(_outside("band"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & ~reject).alias("kept"), "n_tokens", "chars_per_token", "fallback_share", "token_entropy", "script",
        F.when(F.col("by_lang").isNotNull(), F.lit("lang")).when(F.col("by_script").isNotNull(), F.lit("script")).alias("band"))
