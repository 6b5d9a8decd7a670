"""basketry: order-value analytics for e-commerce data as Spark DataFrame jobs."""

__version__ = "0.1.0"
