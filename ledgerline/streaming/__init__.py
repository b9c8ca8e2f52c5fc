"""Structured Streaming ingest of landed report pages."""

from ledgerline.streaming.ingest import ingest_available, page_stream, read_ingested

__all__ = ["ingest_available", "page_stream", "read_ingested"]
