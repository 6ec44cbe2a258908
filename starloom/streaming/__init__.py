"""Incremental updates of additive results from a stream of event files."""
