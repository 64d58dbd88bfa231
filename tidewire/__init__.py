"""Device-telemetry analytics as Spark DataFrame operators and Structured Streaming jobs."""

from tidewire.session import configure, local_session

__all__ = ["configure", "local_session"]
