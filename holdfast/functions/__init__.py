"""Column helpers: native expressions only, no Python UDFs."""
