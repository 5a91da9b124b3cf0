"""How the query modules register what they have."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    """Queries by name, each with its SQL if it has one."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Callable], Callable]:
        def take(function: Callable) -> Callable:
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return take


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
