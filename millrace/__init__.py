"""Dataflow definitions, record transforms, routing and provenance queries as Spark DataFrames."""

from millrace.session import configure, scratch_path, shared_dir

__all__ = ["configure", "scratch_path", "shared_dir"]
