"""Tessera operators."""
