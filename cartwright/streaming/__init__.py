"""Structured Streaming entry points (see ``experiment_monitor``)."""
