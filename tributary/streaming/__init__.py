"""Incremental and streaming variants of the batch pipeline."""
