"""Structured Streaming: keyed call state, streaming sessioniser, wave replay."""
