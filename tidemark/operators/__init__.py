"""Stateful operators over tables: versions, upsert, history, sinks."""
