"""orderloom: order, open-order and inventory extracts as Spark jobs."""

__version__ = "0.1.0"
