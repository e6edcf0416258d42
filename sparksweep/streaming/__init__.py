"""Structured Streaming: file-stream runner and sinks, followed logs, live observations and stateful status processors."""
