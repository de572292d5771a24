"""Explicit schemas of the tables the operators take and give."""

from __future__ import annotations

PIPELINES = "pipeline_id string, name string"
PROCESSORS = (
    "pipeline_id string, pos int, name string, type string, properties map<string,string>, "
    "scheduling map<string,string>, auto_terminated array<string>"
)
CONNECTIONS = (
    "pipeline_id string, pos int, source string, destination string, "
    "relationships array<string>, object_threshold bigint, size_threshold string"
)
SERVICES = "pipeline_id string, pos int, name string, type string, properties map<string,string>"
CONTEXTS = "pipeline_id string, pos int, name string, description string"
PARAMETERS = (
    "pipeline_id string, context_pos int, context string, name string, value string, "
    "sensitive boolean, description string, pos int"
)
PORTS = "pipeline_id string, pos int, name string, port_type string"
REJECTS = "pipeline_id string, reason string"
ISSUES = "pipeline_id string, rule string, subject string, message string"
GROUPS = "group_id string, parent_id string, name string"
PROVENANCE = (
    "event_id bigint, ts timestamp, processor_id string, component_type string, "
    "flowfile_uuid string"
)
HISTORY = "action_id bigint, ts timestamp, source_id string"
BULLETINS = "bulletin_id bigint, ts timestamp, level string, source_id string, message string"
QUEUE = "connection_id string, flowfile_id string, size_bytes bigint, ts timestamp"
EDGES = "src string, dst string"
