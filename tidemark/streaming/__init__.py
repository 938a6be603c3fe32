"""The same runs, fed by Structured Streaming."""
