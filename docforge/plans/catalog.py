"""Import every query module so that the registry is complete."""

from . import q_consolidate, q_dedup, q_files, q_intake, q_pages, q_pipelines, q_quota, q_stream, q_text  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
