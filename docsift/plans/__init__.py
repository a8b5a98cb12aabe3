"""plans of the docsift engine."""
