"""Tessera: a PySpark-native engine to query, reshape and check semi-structured documents."""

__version__ = "0.1.0"
