"""Stored-procedure style jobs: build, save, report what was done."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from ..sources.sinks import read_current, write_version
from .consumption import rfm_segmentation


@dataclass(frozen=True)
class JobResult:
    status: str
    rows: int
    version: int


def _saved(df: DataFrame, path: str, label: str) -> JobResult:
    version = write_version(df, path)
    rows = read_current(df.sparkSession, path).count()
    return JobResult(f"SUCCESS: {label} {rows} customers", rows, version)


def segment_customers(enriched: DataFrame, customers: DataFrame, as_of: Column, path: str) -> JobResult:
    """Segment customers by recency, frequency and spend, and save the result as a new version."""
    return _saved(rfm_segmentation(enriched, customers, as_of), path, "segmented")
