"""Fixed schemas of the library's tables.

What is dynamic in a collection (variable, dimension and attribute names) lives in rows.
"""

from __future__ import annotations

FILES = "project_id string, file_ord int, uri string"
REFS = "project_id string, file_ord int, var string, coords array<int>, path string, offset bigint, size bigint, inline binary"
VAR_META = "project_id string, file_ord int, var string, dims array<string>, shape array<int>, chunks array<int>, dtype string, units string, raw string"
ATTRS = "project_id string, file_ord int, scope string, attr string, value string"
COORDS = "dataset string, file_ord int, dim string, pos int, value double"
CELLS = "dataset string, var string, idx array<int>, value double"
CHUNKS = "dataset string, var string, chunk array<int>, origin array<int>, shape array<int>, values array<double>"
STATUS_LOG = "group_id string, project_id string, line_no bigint, phase string, status string, ts timestamp, job_id string"
REPORT = "project_id string, part string, section string, error string, parent string, name string, detail map<string,string>, skipped boolean"

#: Phases of a project in their order.
PHASES = ("init", "scan", "compute", "validate", "complete")
