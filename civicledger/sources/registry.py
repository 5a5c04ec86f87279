"""Registry of fact sources.

A source is a function ``(spark, options) -> DataFrame`` that yields the long fact schema, so a further
country is one more function.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT_COLUMNS = {
    "phase": "string",
    "region": "string",
    "fiscal_year": "int",
    "amount": "decimal(20,2)",
}

Source = Callable[[SparkSession, dict], DataFrame]


class SourceRegistry:
    """Named sources that all conform to :data:`FACT_COLUMNS`."""

    def __init__(self) -> None:
        self._sources: dict[str, Source] = {}

    def register(self, name: str) -> Callable[[Source], Source]:
        def add(source: Source) -> Source:
            self._sources[name] = source
            return source

        return add

    def names(self) -> list[str]:
        return sorted(self._sources)

    def load(self, spark: SparkSession, options: dict, names: Iterable[str] | None = None) -> DataFrame:
        """Union of the chosen sources, each cast to the fact schema and labelled with its name."""
        chosen = self.names() if names is None else sorted({name.strip().lower() for name in names})
        unknown = [name for name in chosen if name not in self._sources]
        if unknown:
            raise ValueError(f"invalid sources {unknown}; valid are {self.names()}")
        columns = [F.col(name).cast(kind).alias(name) for name, kind in FACT_COLUMNS.items()]
        parts = [self._sources[name](spark, options).select(F.lit(name).alias("source"), *columns) for name in chosen]
        return reduce(DataFrame.unionByName, parts)
