"""Operators on chunk references, metadata, cells, reports and status logs."""
