"""Incremental loading of the fact table with Structured Streaming."""

from arrivals_mart.streaming.fact_stream import (
    STREAMED_FACT,
    fact_stream,
    load_fact_incrementally,
    write_fact_batch,
)

__all__ = ["STREAMED_FACT", "fact_stream", "load_fact_incrementally", "write_fact_batch"]
