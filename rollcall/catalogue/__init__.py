"""Queries bound to the TPC-H-like tables, each with its SQL counterpart."""

from rollcall.catalogue import (  # noqa: F401
    aggregate_queries,
    attendance_queries,
    column_queries,
    domain_queries,
    join_queries,
    model_queries,
    scalar_queries,
    set_queries,
    source_queries,
    stream_queries,
)
