"""operators of the docsift engine."""
