"""Structured Streaming jobs: Bronze stream, console/memory sinks, watermark, continuous Silver."""
