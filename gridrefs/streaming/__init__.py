"""Structured Streaming over status logs."""
