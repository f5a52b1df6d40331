"""Incremental loading: windows, cursor, state, and the streaming form of the upsert."""
