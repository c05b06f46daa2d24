"""The two batch jobs."""
from clickrev.plans.conform import conform
from clickrev.plans.curate import curate, keyword_report

__all__ = ["conform", "curate", "keyword_report"]
