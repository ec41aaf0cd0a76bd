"""Structured Streaming forms: session windows, watermark dedup, the stateful
lifecycle, and model scoring on a stream."""
