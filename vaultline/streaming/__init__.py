"""Structured Streaming jobs: continuous landing ingestion and streamed upserts."""

from vaultline.streaming.jobs import ingest_stream, stream_structured, upsert_batch

__all__ = ["ingest_stream", "stream_structured", "upsert_batch"]
