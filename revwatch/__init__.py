"""Analytics for streams of edit events, as DataFrame and Structured Streaming jobs."""
