"""Structured Streaming jobs."""

from .jobs import (daily_stream, enrich_stream, ingest_stream, load_history, load_stream, loaded_rows, rejected_rows,
                   upsert_stream, write_stream)
