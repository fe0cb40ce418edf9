"""Occupation coding of multilingual job ads as Spark DataFrame jobs."""

from jobweave.config import JobConfig, Sampling

__all__ = ["JobConfig", "Sampling"]
