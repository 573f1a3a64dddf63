"""Readers: topic stream, lake tables, product dimension, JSON array files, table adapters."""
