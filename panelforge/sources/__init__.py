"""Sources and sinks (SRC-*)."""
