"""Structured Streaming: decoding, cleaning, landing and keyed output."""
