"""All queries of this subpackage."""

from tidewell.llm import (  # noqa: F401
    classifier, decontaminate, divergence, licenses, lines, mixing, pii, rules, sharding, simhash, trie, urls, warc,
)
from tidewell.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
