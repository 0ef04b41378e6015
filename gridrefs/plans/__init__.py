"""The library's workloads: scan, combine and validate."""
