"""Resumable processing: bounded batches that continue where the last one stopped."""
