"""Column expressions: text, HTML, links, keys, metadata."""
