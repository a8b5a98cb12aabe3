"""functions of the docsift engine."""
