"""Incremental work: resumable state in batch and in Structured Streaming."""
