"""Structured Streaming: windows over events, and the work queue kept up to date by batches."""
