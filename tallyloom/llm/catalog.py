"""All queries of this subpackage; importing the operators registers them."""

from tallyloom.llm import alignment, decontamination, exact_dedup, html_text, language_id, mixing, packing, resampling, simhash, substring_dedup, toxicity, url_filter, vector_search  # noqa: F401
from tallyloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
