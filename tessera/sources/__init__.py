"""Tessera sources."""
