"""All registered queries."""

from quern.plans import corpus, dialogs, eval_jobs, retrieval_jobs, token_jobs  # noqa: F401
from quern.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
