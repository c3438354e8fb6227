"""Structured Streaming jobs (T1-T4): file-stream ingest, de-duplication,
watermarked window profiles, stream scoring, streamed monitoring refresh."""
