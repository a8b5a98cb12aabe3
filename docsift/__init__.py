"""docsift: a Spark-first engine for typed, de-duplicated document catalogues."""

__version__ = "0.1.0"
