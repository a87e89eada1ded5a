"""Every query of this package; importing the operators registers them."""

from churnkit.llm import decontaminate, exact_dedup, filter_audit, line_dedup, near_duplicates, packing, quality_model  # noqa: F401
from churnkit.llm import quality_rules, quotations, substring_dedup, token_counts, toxicity, variants  # noqa: F401
from churnkit.llm.registry import ORACLES, QUERIES  # noqa: F401
