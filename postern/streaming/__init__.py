"""The same job on streams."""
