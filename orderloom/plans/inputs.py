"""What the registered queries start from: extracts, published rows and mappings of one folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators import identities, privacy
from orderloom.session import Relay, materialize, prepare
from orderloom.sources import table_extracts as extracts
from orderloom.spec import IDENTITY_COLUMNS, PRODUCT_COLUMNS

# The salt of the demonstration queries; real runs pass their own secret.
DEMO_SALT = "demonstration-salt"
RUN_AT = datetime(2026, 9, 15, 3, 26, 45)
STANDARDIZED = datetime(2026, 9, 15, 3, 20, 0)


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self._committed: dict[str, DataFrame] = {}
        self._copies: list[Relay] = []

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A mapping that several batches are looked up in is built and stored once."""
        if name not in self._committed:
            self._committed[name] = build()
        return self._committed[name]

    # extracts

    def history(self, *columns: str) -> DataFrame:
        return extracts.order_history(self.spark, self.sf_dir, columns or None)

    def open_orders(self, *columns: str) -> DataFrame:
        return extracts.open_orders(self.spark, self.sf_dir, columns or None)

    def inventory(self, *columns: str) -> DataFrame:
        return extracts.inventory(self.spark, self.sf_dir, columns or None)

    def raw_history(self) -> DataFrame:
        return extracts.published_order_history(self.spark, self.sf_dir)

    def raw_open_orders(self) -> DataFrame:
        return extracts.published_open_orders(self.spark, self.sf_dir)

    def raw_inventory(self) -> DataFrame:
        return extracts.published_inventory(self.spark, self.sf_dir)

    def categories(self) -> DataFrame:
        return extracts.category_mapping(self.spark, self.sf_dir)

    def _prior(self, rows: DataFrame, columns: Iterable[str]) -> DataFrame:
        return rows.where(F.col("order_date") < extracts.PRIOR_BEFORE).select(*columns)

    def prior_history(self, *columns: str) -> DataFrame:
        """The order history as the previous run saw it."""
        return self._prior(self.history(*columns, "order_date"), columns)

    # mappings, each as committed after its run

    def prior_customers(self) -> DataFrame:
        profile = materialize(identities.customer_profile(self.prior_history(*IDENTITY_COLUMNS)), "profile")
        return materialize(identities.map_customers(profile, None), "customers")

    def customers(self) -> DataFrame:
        profile = materialize(identities.customer_profile(self.history(*IDENTITY_COLUMNS)), "profile")
        return materialize(identities.map_customers(profile, self.prior_customers()), "customers")

    def prior_product_profile(self) -> DataFrame:
        return identities.product_profile(self.prior_history(*PRODUCT_COLUMNS, *extracts.POSITION))

    def product_profile(self) -> DataFrame:
        return identities.product_profile(self.history(*PRODUCT_COLUMNS, *extracts.POSITION))

    def stored_product_profile(self) -> DataFrame:
        """The profile as the profiling job leaves it; mapping reads it more than once."""
        return materialize(self.product_profile(), "profile")

    def prior_products(self) -> DataFrame:
        profile = materialize(self.prior_product_profile(), "profile")
        mapping = identities.build_product_mapping(profile, self.categories(), None)
        return materialize(mapping, "product-mapping")

    def products(self) -> DataFrame:
        return self._once("products", self._products)

    def _products(self) -> DataFrame:
        mapping = identities.build_product_mapping(
            self.stored_product_profile(), self.categories(), self.prior_products()
        )
        return materialize(mapping, "product-mapping")

    def prior_routes(self) -> DataFrame:
        rows = self._prior(self.open_orders("delivery_route_name", "order_date"), ["delivery_route_name"])
        profile = materialize(identities.route_profile(rows), "profile")
        return materialize(identities.map_routes(profile, None), "routes")

    def routes(self) -> DataFrame:
        profile = materialize(identities.route_profile(self.open_orders("delivery_route_name")), "profile")
        return materialize(identities.map_routes(profile, self.prior_routes()), "routes")

    # pseudonymized batches, each stored

    def _relay(self, label: str) -> Relay:
        self._copies.append(Relay(label))
        return self._copies[-1]

    def drop_copies(self) -> None:
        """Remove the batches made so far; call it once nothing reads them any more."""
        while self._copies:
            self._copies.pop().clear()

    def pseudonymized_history(self) -> DataFrame:
        standardized = self.history(*extracts.ORDER_HISTORY_COLUMNS)
        return privacy.pseudonymize_order_history(
            standardized, self.products(), self.customers(), DEMO_SALT, RUN_AT, self._relay("history")
        )

    def pseudonymized_open_orders(self) -> DataFrame:
        standardized = self.open_orders(*extracts.OPEN_ORDERS_COLUMNS)
        return privacy.pseudonymize_open_orders(
            standardized, self.products(), self.customers(), self.routes(), DEMO_SALT, RUN_AT, self._relay("open-orders")
        )

    def pseudonymized_inventory(self) -> DataFrame:
        standardized = self.inventory(*extracts.INVENTORY_COLUMNS)
        return privacy.pseudonymize_inventory(standardized, self.products(), DEMO_SALT, RUN_AT, self._relay("inventory"))
