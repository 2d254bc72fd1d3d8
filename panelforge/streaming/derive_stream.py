"""Apply stateless derive steps (date parts, expressions, bins, mappings, street names) to a
Structured Streaming source, writing each micro-batch with ``foreachBatch``.

Grouped and windowed steps need whole history and are left to the batch plans.
"""
from __future__ import annotations

from typing import Any, Mapping, Sequence

from pyspark.sql import DataFrame

from panelforge.plans.derive import run_derive

STATELESS = {"simple", "bin"}


def stateless_steps(steps: Sequence[Mapping[str, Any]]) -> list[Mapping[str, Any]]:
    """Keep only row-level steps; a date_parts step on a stream cannot pre-check all-NULL input."""
    return [s for s in steps if s.get("type") in STATELESS and s.get("method") != "to_month_index"]


def derive_stream(stream: DataFrame, steps: Sequence[Mapping[str, Any]], sink_path: str, checkpoint: str,
                  trigger_once: bool = True):
    """Start a query that derives columns per micro-batch and appends them as Parquet; other than row-level steps raise."""
    row_steps = stateless_steps(steps)
    if len(row_steps) < len(steps):
        left_out = [s.get("method") or s.get("type") for s in steps if s not in row_steps]
        raise ValueError(f"steps that need whole history can't run on a stream: {left_out}")

    def batch(df: DataFrame, epoch_id: int) -> None:
        out = run_derive(df, [dict(s, **({"skip_all_null_check": True} if s.get("method") == "date_parts" else {}))
                              for s in row_steps])
        out.write.mode("append").parquet(sink_path)

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
