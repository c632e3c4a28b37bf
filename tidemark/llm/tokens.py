"""Token ids of whole texts, and operator 2: the exact length histogram."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import filled, replaced
from tidemark.session import checkpointed

# What a worker's words and ids may take together, with some 200 bytes for each entry.  Workers hold them while they run
# the tasks of other operators, so this is little against an executor's memory.
_CACHED_BYTES = 64 << 20
# Fixed marks: a run of them after a letter or digit is a token run of its own.
_MARKS = b".,;:!?"
# Words of these letters alone are in composed form, have plain lower-case forms, and are not split further.
_LETTERS = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes themselves, others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(rest)) for b in range(256)}


class WordIds(dict):
    """The ids of blank-separated words as little-endian 32-bit numbers, each word encoded once.

    Right for byte-level vocabularies that fold case and drop white space before they merge: a text's ids
    are then its words' ids in a row, and a word's are those of its core in lower case and of the
    marks after it.  Plain cores go to the merges at once, all others through the whole
    tokenizer.  Bounded by bytes: a full cache starts again, and a very long word is not kept.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._merge = self._tokenizer.model.tokenize
        self._ids = [n.to_bytes(4, "little") for n in range(self._tokenizer.get_vocab_size())]
        self._letters = _byte_letters()
        self._bytes = 0

    def __missing__(self, word: bytes) -> bytes:
        # A special token is one only as it is spelt.
        core = word if b"<|" in word else word.lower()
        tail = core[len(core.rstrip(_MARKS)):]
        if tail and core[-len(tail) - 1: -len(tail)].isalnum():
            ids = self[core[: -len(tail)]] + self[tail]
        elif core != word:
            ids = self[core]
        else:
            ids = self._encoded(word)
        cost = len(word) + len(ids) + 200
        if cost * 64 <= _CACHED_BYTES:
            if self._bytes + cost > _CACHED_BYTES:
                self.clear()
                self._bytes = 0
            self[word] = ids
            self._bytes += cost
        return ids

    def _encoded(self, word: bytes) -> bytes:
        if word.isalpha():
            letters = word.decode()
        else:
            text = word.decode("utf-8", "replace")
            if not _LETTERS.fullmatch(text):
                return b"".join([self._ids[n] for n in self._tokenizer.encode(text, add_special_tokens=False).ids])
            letters = text.lower().encode().decode("latin-1").translate(self._letters)
        return b"".join([self._ids[t.id] for t in self._merge(letters)])


_caches: dict[str, WordIds] = {}


def encoder(path: str) -> Callable[[bytes], bytes]:
    """A function from a text's bytes to its ids' bytes; workers keep the cache between tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    cache = _caches.get(path)
    if cache is None:
        cache = _caches[path] = WordIds(path)

    def encode(text: bytes) -> bytes:
        return b"".join(map(cache.__getitem__, text.split()))

    return encode


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """One row ``n_tokens`` per document: the ids in its whole text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            texts = filled(batch, "text")
            counts = [len(encode(t.as_buffer().to_pybytes())) // 4 for t in texts]
            yield pa.record_batch([pa.array(counts, pa.int64())], names=["n_tokens"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "n_tokens bigint")


def length_histogram(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``n_tokens, documents``: how many documents have each encoded length.  Texts are encoded once."""
    counted = token_counts(docs, path, text).groupBy("n_tokens").agg(F.count("*").alias("documents"))
    return checkpointed(counted, "lengths")


_BLOCK = 1024


def context_limits(histogram: DataFrame) -> DataFrame:
    """Totals for every context limit, from suffix sums over the histogram.

    One row per length that occurs (between two of them all totals are linear in the limit):
    ``context_limit, documents, documents_longer, tokens_longer`` (of the documents over the
    limit), ``total_documents, total_tokens, truncated_tokens`` (what is left when each document
    is cut to the limit) and ``quantile`` (share of documents within the limit).

    Sums run within blocks of 1024 lengths; only block totals meet in one task.  An empty
    table has no rows.
    """
    length, docs = F.col("n_tokens"), F.col("documents")
    blocked = histogram.select("n_tokens", "documents", F.floor(length / _BLOCK).alias("block"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    blocks = (
        blocked.groupBy("block").agg(F.sum("documents").alias("d"), F.sum(length * docs).alias("t"))
        .select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_d"),
                F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_t"),
                F.sum("d").over(everything).alias("total_documents"),
                F.sum("t").over(everything).alias("total_tokens"))
    )
    above = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    longer: Column = F.coalesce(F.sum("documents").over(above), F.lit(0)) + F.col("later_d")
    tokens: Column = F.coalesce(F.sum(length * docs).over(above), F.lit(0)) + F.col("later_t")
    summed = blocked.join(blocks, "block").select(
        length.alias("context_limit"), "documents", longer.alias("documents_longer"), tokens.alias("tokens_longer"),
        "total_documents", "total_tokens")
    return replaced(summed, {
        "truncated_tokens": F.col("total_tokens") - F.col("tokens_longer")
        + F.col("documents_longer") * F.col("context_limit"),
        "quantile": 1 - F.col("documents_longer") / F.col("total_documents"),
    })


def quantile(limits: DataFrame, q: float) -> DataFrame:
    """The shortest length that at least a share ``q`` of the documents does not exceed; one row, null if none."""
    return limits.filter(F.col("quantile") >= F.lit(q)).agg(F.min("context_limit").alias("n_tokens"))


def truncated(histogram: DataFrame, limit: int) -> DataFrame:
    """Tokens and cut documents when each document is cut to ``limit`` ids; one row."""
    kept = F.least(F.col("n_tokens"), F.lit(limit)) * F.col("documents")
    return histogram.agg(
        F.coalesce(F.sum(kept), F.lit(0)).alias("truncated_tokens"),
        F.coalesce(F.sum(F.when(F.col("n_tokens") > limit, F.col("documents"))), F.lit(0)).alias("documents_longer"))
