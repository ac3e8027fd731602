"""Declared sources, the views built on them, and data tests on both, in Spark's catalog.

A view names what it uses; registering it registers those first. Sources are DataFrames or names
of tables, and must have the columns their declaration lists. Everything is a temporary view, so
queries and tests refer to ``stg_order_history`` and the like by name and Spark plans them whole;
nothing is stored. A data test is a view of the rows that break it, and holds when it is empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.guards import GuardError, require_columns
from orderloom.plans import staging
from orderloom.spec import INVENTORY, OPEN_ORDERS, ORDER_HISTORY


@dataclass(frozen=True)
class View:
    uses: tuple[str, ...]
    build: Callable[..., DataFrame]


SOURCES: dict[str, T.StructType] = {f"raw_{spec.name}": spec.published for spec in (ORDER_HISTORY, OPEN_ORDERS, INVENTORY)}

VIEWS: dict[str, View] = {
    "stg_order_history": View(("raw_order_history",), staging.stg_order_history),
    "stg_open_orders": View(("raw_open_orders",), staging.stg_open_orders),
}


def _unique(keys: tuple[str, ...], name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda view: staging.repeated_combinations(view, keys, name)


_HISTORY, _OPEN = ("raw_order_history", "stg_order_history"), ("raw_open_orders", "stg_open_orders")

TESTS: dict[str, View] = {
    "order_history_quantities_preserved": View(_HISTORY, staging.quantities_changed),
    "order_history_row_count_preserved": View(_HISTORY, staging.row_count_difference),
    "order_history_source_position_unique": View(_HISTORY[1:], _unique(staging.SOURCE_POSITION, "records_at_position")),
    "open_orders_measures_preserved": View(_OPEN, staging.measures_changed),
    "open_orders_dates_standardized": View(_OPEN, staging.dates_not_standardized),
    "open_orders_row_count_preserved": View(_OPEN, staging.row_count_difference),
    "open_orders_candidate_key_unique": View(_OPEN[1:], _unique(staging.BUSINESS_KEY, "records_per_candidate_key")),
    "open_orders_source_position_unique": View(_OPEN[1:], _unique(staging.SOURCE_POSITION, "records_at_position")),
}


class Catalog:
    """The declared views over given sources. ``prefix`` keeps several catalogs of a session apart."""

    def __init__(
        self, spark: SparkSession, sources: Mapping[str, DataFrame | str], prefix: str = "",
        declared: Mapping[str, T.StructType] = SOURCES, views: Mapping[str, View] | None = None, tests: Mapping[str, View] = TESTS,
    ):
        unknown = sorted(set(sources) - set(declared))
        if unknown:
            raise GuardError(f"Undeclared source(s): {unknown}")
        self.spark, self.prefix, self.declared = spark, prefix, declared
        self.sources, self.views, self.tests = dict(sources), dict(VIEWS if views is None else views), dict(tests)
        self._done: dict[str, DataFrame] = {}

    def view(self, name: str) -> DataFrame:
        """A source, view or test by name, registered with all it uses."""
        return self._register(name, ())

    def register(self, names: Iterable[str] | None = None) -> list[str]:
        """Register views, by default all whose sources are given; returns the names in the catalog."""
        if names is None:
            names = [n for n in self.views if self._origins(n) <= set(self.sources)]
        for name in names:
            self.view(name)
        return [self.prefix + name for name in self._done]

    def _origins(self, name: str) -> set[str]:
        if name in self.declared:
            return {name}
        return set().union(*(self._origins(used) for used in (self.views | self.tests)[name].uses))

    def _register(self, name: str, above: tuple[str, ...]) -> DataFrame:
        if name in self._done:
            return self._done[name]
        if name in above:
            raise GuardError(f"Views use each other: {' > '.join((*above, name))}")
        declared = self.views | self.tests
        if name in self.declared:
            if name not in self.sources:
                raise GuardError(f"Source {name} is not given.")
            given = self.sources[name]
            built = self.spark.table(given) if isinstance(given, str) else given
            require_columns(built, self.declared[name].names, name)
        elif name in declared:
            built = declared[name].build(*(self._register(used, (*above, name)) for used in declared[name].uses))
        else:
            raise GuardError(f"No source, view or test is called {name}.")
        built.createOrReplaceTempView(self.prefix + name)
        self._done[name] = self.spark.table(self.prefix + name)
        return self._done[name]

    def lineage(self) -> DataFrame:
        """``view, uses``: what each declared view and test is built from."""
        rows = [(name, used) for name, view in (self.views | self.tests).items() for used in view.uses]
        return self.spark.createDataFrame(rows, "view string, uses string")

    def run_tests(self, names: Iterable[str] | None = None) -> DataFrame:
        """``test, failing_rows`` of the named tests, by default of all whose sources are given, in one job."""
        names = list(names if names is not None else (n for n in self.tests if self._origins(n) <= set(self.sources)))
        counted = [self.view(n).agg(F.count("*").alias("failing_rows")).select(F.lit(n).alias("test"), "failing_rows") for n in names]
        if not counted:
            return self.spark.createDataFrame([], "test string, failing_rows bigint")
        result = counted[0]
        for part in counted[1:]:
            result = result.unionByName(part)
        return result

    def drop(self) -> None:
        for name in self._done:
            self.spark.catalog.dropTempView(self.prefix + name)
        self._done.clear()
