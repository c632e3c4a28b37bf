"""What every registered query starts from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.marts import Marts, Settings
from workload.bindings import AS_OF_EVENTS, AS_OF_ORDERS, SPINE_START, TEST_ACCOUNTS, RawTables
from workload.edge import plain

EVENTS_FROM = "2024-01-01"

SETTINGS = Settings(as_of=AS_OF_ORDERS, start=SPINE_START, events_from=EVENTS_FROM, events_to=AS_OF_EVENTS,
                    test_ids=TEST_ACCOUNTS)
# The single operators as they are defined: test accounts leave the account table only.
AS_DEFINED = Settings(as_of=AS_OF_ORDERS, start=SPINE_START, events_from=EVENTS_FROM, events_to=AS_OF_EVENTS)


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = RawTables(spark, sf_dir)
        self.marts = Marts(self.raw, SETTINGS)

    def base(self, table: str) -> DataFrame:
        return self.raw.base(table)


class Registry:
    """Queries and their SQL counterparts of one domain."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, build: Callable[[Context], DataFrame], sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"{name} is registered twice")
        self.queries[name] = lambda spark, sf_dir: plain(build(Context(spark, sf_dir)))
        if sql is not None:
            from workload.oracle import oracle

            self.oracles[name] = oracle(sql)

    def alike(self, name: str, build: Callable[[Context], DataFrame], other: str) -> None:
        """A query that must give what ``other`` gives, by another way; it is checked against the same SQL."""
        self.add(name, build)
        self.oracles[name] = self.oracles[other]
