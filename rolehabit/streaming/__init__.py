"""The same detection as Structured Streaming jobs."""
