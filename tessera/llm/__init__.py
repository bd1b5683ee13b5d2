"""Training-data operators over free text. Nothing outside this package imports it."""
