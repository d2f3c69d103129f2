"""Where the queries that exercise sinks write their tables."""

from veritable.sources.scratch import scratch_path

__all__ = ["scratch_path"]
