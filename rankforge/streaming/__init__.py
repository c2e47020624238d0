"""Structured Streaming forms of the chart operators."""

from rankforge.streaming.chart_stream import (
    best_rank_updates,
    chart_stream,
    current_best_rank,
    run_best_rank,
)

__all__ = ["best_rank_updates", "chart_stream", "current_best_rank", "run_best_rank"]
