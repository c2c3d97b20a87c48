"""Marketing lakehouse on Spark: landing, cleaning, enrichment, load and reporting tables."""

from millrace.session import build_session

__all__ = ["build_session"]
