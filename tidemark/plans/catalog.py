"""Imports every query module so that the registry is complete."""

from tidemark.plans import q_asof, q_folder, q_ingest, q_io, q_jobs, q_merge, q_star_kpi, q_stream, q_table  # noqa: F401
from tidemark.plans.registry import REGISTRY


def all_queries():
    return dict(REGISTRY)
