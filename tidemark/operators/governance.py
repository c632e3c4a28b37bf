"""Tags, masking, row access, audit log, erasure and retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.dates import day, instant
from tidemark.functions.masks import POLICIES

# Classifications, privileged roles, content patterns, audit text length.
CLASSIFICATIONS = ("public", "internal", "confidential", "pii", "financial")
TERRITORY_ROLES = ("admin", "engineer", "finance")
CONTENT_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}",
}


def tag_columns(df: DataFrame, tags: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """Attach tags (classification, owner, retention_days, domain, policy) to columns."""
    for column, tag in tags.items():
        if tag.get("classification", "internal") not in CLASSIFICATIONS:
            raise ValueError(f"unknown classification {tag['classification']!r}")
        df = df.withMetadata(column, dict(tag))
    return df


def apply_policies(df: DataFrame, role: str) -> DataFrame:
    """Mask every column whose ``policy`` tag names a masking policy."""
    masked = {f.name: POLICIES[f.metadata["policy"]](F.col(f"`{f.name}`"), role)
              for f in df.schema.fields if "policy" in f.metadata}
    return df.withColumns(masked) if masked else df


def row_access(df: DataFrame, role: str, user: str, territories: DataFrame,
               column: str = "territory_id") -> DataFrame:
    """Rows of the user's territories; privileged roles see all, unmapped users none.

    The role is decided while the plan is built, so privileged plans carry no join.
    """
    if role in TERRITORY_ROLES:
        return df
    own = territories.filter(F.col("user_email") == user).select(F.col("territory_id").alias(column))
    return df.join(own, column, "left_semi")


def access_log(history: DataFrame, as_of: date | str, text_chars: int | None = None) -> DataFrame:
    """Accesses of the last day that touched objects, with their whole text, or its first ``text_chars``."""
    def given(name: str) -> Column:
        return F.col(name) if name in history.columns else F.lit(None).cast("string").alias(name)

    at = F.col("start_time").cast("timestamp_ntz")
    recent = history.filter((at >= instant(as_of) - F.expr("interval 1 day")) & F.col("objects_accessed").isNotNull())
    return recent.select(
        F.sha2(F.concat_ws("-", "query_id", at.cast("string")), 256).alias("log_id"), "query_id", "user_name",
        given("role_name"), "warehouse_name",
        (F.col("query_text") if text_chars is None else F.left("query_text", F.lit(text_chars))).alias("query_text"),
        given("database_name"), given("schema_name"), "objects_accessed", at.alias("query_start_time"),
        instant(as_of).alias("loaded_at"))


def pii_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every column with its tags, plus the share of text values that look like personal data.

    One aggregate pass per table over whole texts; a table gives one row per column.
    """
    result = None
    for name, df in tables.items():
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        totals = [F.count("*").alias("_rows")]
        for c in texts:
            totals += [F.count(F.when(F.col(f"`{c}`").rlike(p), 1)).alias(f"{kind}:{c}")
                       for kind, p in CONTENT_PATTERNS.items()]
        rows = []
        for f in df.schema.fields:
            hits = [F.col(f"`{kind}:{f.name}`") if f.name in texts else F.lit(0).cast("bigint")
                    for kind in CONTENT_PATTERNS]
            found = hits[0]
            for h in hits[1:]:
                found = found + h
            tag = f.metadata
            rows.append(F.struct(
                F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(tag.get("classification")).cast("string").alias("classification"),
                F.lit(tag.get("owner")).cast("string").alias("owner"),
                F.lit(tag.get("retention_days")).cast("int").alias("retention_days"),
                F.col("_rows").alias("row_count"),
                *[h.alias(f"{kind}_rows") for kind, h in zip(CONTENT_PATTERNS, hits)],
                (F.lit(tag.get("classification") != "pii") & (found > 0)).alias("is_untagged_hit")))
        part = df.agg(*totals).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        result = part if result is None else result.unionByName(part)
    return result


def erase_subjects(df: DataFrame, column: str, subjects: DataFrame) -> DataFrame:
    """Rows of everyone else; rows without a subject id stay."""
    gone = subjects.select(F.col(subjects.columns[0]).alias(column))
    return df.join(gone, column, "left_anti").select(*df.columns)


def erasure_log(df: DataFrame, table: str, column: str, subjects: DataFrame, as_of: date | str) -> DataFrame:
    """Rows erased per subject, with the subject id only as a hash."""
    asked = subjects.select(F.col(subjects.columns[0]).alias(column)).distinct()
    counted = df.join(asked, column, "left_semi").groupBy(column).agg(F.count("*").alias("n"))
    return asked.join(counted, column, "left").select(
        F.lit(table).alias("table_name"), F.sha2(F.col(column), 256).alias("subject_hash"),
        F.coalesce("n", F.lit(0)).alias("rows_erased"), day(as_of).alias("erased_on"))


def apply_retention(df: DataFrame, date_column: str, as_of: date | str, hot_days: int = 90,
                    keep_days: int = 2555) -> tuple[DataFrame, DataFrame]:
    """Hot rows and rows for the archive; rows past ``keep_days`` are in neither.

    Both are plain predicates on the date column, so whole partitions are kept or skipped.
    """
    d, hot_from, keep_from = F.col(date_column), F.date_sub(day(as_of), hot_days), F.date_sub(day(as_of), keep_days)
    return df.filter(d >= hot_from), df.filter((d < hot_from) & (d >= keep_from))


def forbidden_columns(tables: Mapping[str, DataFrame], allowed_domains: Sequence[str] = ("hr",),
                      names: Sequence[str] = ("first_name", "last_name")) -> list[tuple[str, str, str]]:
    """Personal columns outside the allowed domains, as (table, column, reason).

    ``tables`` maps ``domain.table`` to a DataFrame; only schemas are looked at.
    """
    found = []
    for full_name, df in tables.items():
        if full_name.split(".", 1)[0] in allowed_domains:
            continue
        for f in df.schema.fields:
            if f.name in names:
                found.append((full_name, f.name, "personal name"))
            elif f.metadata.get("classification") == "pii":
                found.append((full_name, f.name, "tagged pii"))
    return found


def forbidden_columns_report(tables: Mapping[str, DataFrame], **options) -> DataFrame:
    """The violations with the number of filled values each of them exposes."""
    violations = forbidden_columns(tables, **options)
    result = None
    for table, column, reason in violations:
        part = tables[table].agg(F.count(F.col(column)).alias("exposed_values")).select(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(reason).alias("reason"),
            "exposed_values")
        result = part if result is None else result.unionByName(part)
    if result is None:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "table_name string, column_name string, reason string, exposed_values bigint")
    return result
