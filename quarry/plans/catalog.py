"""All registered queries (importing the modules registers them)."""

from quarry.plans import q_prepare, q_sampling, q_sources, q_tokens, q_langid, q_eval, q_near  # noqa: F401
from quarry.plans.registry import ORACLE, QUERIES  # noqa: F401
