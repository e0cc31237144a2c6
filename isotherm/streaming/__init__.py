"""Incremental intake: the batch job and its Structured Streaming (foreachBatch) wrapper."""
