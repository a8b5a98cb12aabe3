"""streaming of the docsift engine."""
