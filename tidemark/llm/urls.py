"""Operator 4: URL filters from stated rules and mined token combinations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import join_few
from tidemark.session import checkpointed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
BLOCKED = "verdict=block"
SUPPORT, CONFIDENCE = 0.002, 0.8


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits.

    A rule ``host/path`` fits its host and all subdomains if the path starts with the rule's.  ``rules`` is a list
    of (verdict, rule) short enough to be part of a plan.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def tokens_of(host: Column, path: Column) -> Column:
    """Different tokens of a URL: host labels by their place from the right, and path segments by theirs, in lower case."""
    labels = F.filter(F.reverse(F.split(host, r"\.")), lambda x: x != "")
    segments = F.filter(F.split(F.translate(path, UPPER, LOWER), "/"), lambda x: x != "")
    return F.array_distinct(F.concat(_placed("h", labels), _placed("p", segments)))


def _placed(kind: str, parts: Column) -> Column:
    return F.transform(parts, lambda x, i: F.concat(F.lit(kind), i.cast("string"), F.lit(":"), x))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """``rule_id, tokens, size, confidence, support``: token combinations that mean a block.

    ``labelled`` has ``tokens`` and ``blocked`` (boolean), a row per page.  ``support`` is the share of blocked pages with the
    combination among all pages.  Tokens rare among blocked pages cannot be
    in a rule and are left out first, and of tokens that always stand together one is enough.  FP-growth then finds frequent combinations, and rules
    stay whose consequence is the block, whose support and confidence are high enough, and of which no part is
    a rule of at least that confidence.
    """
    n = labelled.count()
    blocked = labelled.filter("blocked")
    least = max(2, int(support * n))
    useful = (blocked.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("c"))
              .filter(F.col("c") >= least).select("token"))
    empty = labelled.sparkSession.createDataFrame([], "rule_id bigint, tokens array<string>, size int, confidence double, "
                                                      "support double")
    if n == 0 or useful.isEmpty():
        return empty
    keyed = checkpointed(labelled.select(F.monotonically_increasing_id().alias("row"), "tokens", "blocked"), "transactions")
    kept = join_few(keyed.select("row", "blocked", F.explode("tokens").alias("token")), useful, ["token"])
    # Tokens that stand in the same rows are one token: else each set of them would be a combination of its own.
    alike = (kept.groupBy("token").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("row")).alias("x"),
                                       F.sum(F.xxhash64("row") % 1_000_003).alias("y"))
             .groupBy("c", "x", "y").agg(F.min("token").alias("token")).select("token"))
    items = checkpointed(join_few(kept, checkpointed(alike, "tokens"), ["token"], "left_semi").groupBy("row", "blocked")
                         .agg(F.collect_set("token").alias("items")).select(
        F.when(F.col("blocked"), F.concat("items", F.array(F.lit(BLOCKED)))).otherwise(F.col("items")).alias("items")), "items")
    # Supports are shares of the rows given to the fit; half a row less keeps the least count itself safe from rounding.
    fitted = items.count()
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / fitted, minConfidence=confidence).fit(items)
    rules = checkpointed(
        model.associationRules.filter(F.col("consequent")[0] == BLOCKED)
        .select(F.xxhash64(F.array_sort("antecedent")).alias("rule_id"), F.array_sort("antecedent").alias("tokens"),
                F.size("antecedent").alias("size"), "confidence", (F.col("support") * fitted / n).alias("support")), "rules")
    # A rule goes if one of its parts with a token less, or one below that, is as sure.
    parts = rules.select("rule_id", "confidence", F.explode("tokens").alias("gone"), "tokens").select(
        "rule_id", "confidence", F.xxhash64(F.array_remove("tokens", F.col("gone"))).alias("part"))
    sure = rules.select(F.col("rule_id").alias("part"), F.col("confidence").alias("theirs"))
    weaker = parts.join(sure, "part").filter(F.col("theirs") >= F.col("confidence")).select("rule_id").distinct()
    return rules.join(weaker, "rule_id", "left_anti")


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, confidence`` of the (host, path) pairs that fit a mined rule, by an inverted index token -> rule."""
    index = rules.select(F.explode("tokens").alias("token"), "rule_id", "size", "confidence")
    tokens = urls.select("host", "path", F.explode("tokens").alias("token"))
    hits = (join_few(tokens, index, ["token"]).groupBy("host", "path", "rule_id", "size", "confidence")
            .agg(F.count("*").alias("n")).filter(F.col("n") == F.col("size")))
    return hits.groupBy("host", "path").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], page_id: str = "page_id", url: str = "url",
          support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence`` for every row of ``pages``.

    Where a stated rule fits, its verdict holds.  These verdicts are also the labels from which
    token combinations are mined; pages that no rule fits count as not blocked there, so only combinations
    that nearly always mean a block can be rules.  Elsewhere a page is blocked if a mined rule fits, with that rule's
    confidence, and else allowed.  Null and malformed urls have no tokens and are allowed; repeated rows get equal
    verdicts; other columns are ignored; an empty table stays empty.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    split = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    name, said = rule_of(F.col("host"), F.col("path"), rules)
    ruled = checkpointed(split.select("page_id", "host", "path", name.alias("rule"), said.alias("said")), "pages")
    labelled = ruled.select(tokens_of(F.col("host"), F.col("path")).alias("tokens"),
                            F.coalesce(F.col("said") == "block", F.lit(False)).alias("blocked"))
    mined = checkpointed(mine(labelled, support, confidence), "mined")
    open_urls = ruled.filter("said is null and host != ''").select("host", "path").distinct()
    found = matches(open_urls.withColumn("tokens", tokens_of(F.col("host"), F.col("path"))), mined)
    judged = ruled.join(found, ["host", "path"], "left")
    verdict = F.coalesce("said", F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "confidence")
