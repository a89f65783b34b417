"""Operators for preparing training text: filters, de-duplication, redaction,
archives and packing. Nothing outside this subpackage imports it."""
