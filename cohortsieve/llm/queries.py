"""All queries of the subpackage."""

from cohortsieve.llm import decontaminate, jaccard_join, line_dedup, mixing, personal_data, quality_rules, suffix_match, token_counts, toxicity, url_filter, vector_codes, warc, whitening  # noqa: F401
from cohortsieve.llm.registry import CHECKS, QUERIES  # noqa: F401
