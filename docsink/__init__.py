"""Change streams to document tables, as DataFrame transformations."""
