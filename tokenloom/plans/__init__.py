"""Registered queries and their DuckDB oracles (imported for registration)."""

from tokenloom.plans import (  # noqa: F401
    io_queries,
    model_queries,
    stream_queries,
    streaming_queries,
    tokenizer_queries,
    vector_queries,
)
