"""The incremental daily rollup on Structured Streaming."""
