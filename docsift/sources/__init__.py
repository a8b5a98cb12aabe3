"""sources of the docsift engine."""
