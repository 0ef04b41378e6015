"""Queries of the reference work on the driver's tables, each with its SQL."""

from . import comparing, scanning, storing, tracking, whole

QUERIES = {**scanning.QUERIES, **comparing.QUERIES, **tracking.QUERIES, **storing.QUERIES, **whole.QUERIES}
SQL = {**scanning.SQL, **comparing.SQL, **tracking.SQL, **storing.SQL, **whole.SQL}
