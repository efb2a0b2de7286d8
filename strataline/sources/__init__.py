"""Readers and writers; every reader takes an explicit schema or a Parquet footer, never inference over data."""
