"""Structured Streaming form of the monthly feed."""
