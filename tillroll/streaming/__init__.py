"""Structured Streaming: daily revenue per customer and a live top segment."""
