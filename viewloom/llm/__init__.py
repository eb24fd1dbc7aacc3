"""Operators for training corpora. Each module holds one operator, its registered query and the SQL to check it against."""

from viewloom.llm import (  # noqa: F401
    column_bwt,
    filter_audit,
    hard_negatives,
    language_ftrl,
    line_runs,
    one_bit_codes,
    ordinal_toxicity,
    pii_votes,
    poisson_mix,
    simhash_trees,
    url_rules,
    warc_salvage,
    winnowing,
)
from viewloom.llm.common import ORACLES, QUERIES  # noqa: F401
