"""Tessera: a PySpark-native engine for multilingual document collections and their reference graphs."""
