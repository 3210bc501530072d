"""How a query and its DuckDB text are registered."""

from __future__ import annotations

from slotwise.catalog.views import oracle, plain
from slotwise.session import configure


class Registry:
    def __init__(self) -> None:
        self.queries: dict = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, views: list[str] | None = None, sql: str | None = None):
        """Register a function (spark, sf_dir) -> DataFrame; without SQL only rows are checked."""

        def register(fn):
            self.queries[name] = lambda spark, sf: plain(fn(configure(spark), sf))
            if sql is not None:
                self.oracles[name] = oracle(views, sql) if views else sql.strip()
            return fn

        return register
