"""Incremental versions of the snapshot loads."""
