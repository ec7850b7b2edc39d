"""All registered queries over text corpora."""

from ledgerline.llm import bpe, exact_dedup, fingerprint, jaccard, licenses, lines, mixing, pages, periodic, pii, quality, search, toxicity  # noqa: F401
from ledgerline.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
