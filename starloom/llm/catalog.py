"""All registered queries of this subpackage; importing it registers them."""

from starloom.llm import (  # noqa: F401
    bpe,
    collocations,
    decontaminate,
    licenses,
    line_crf,
    near_dedup,
    pack,
    quality_rules,
    secrets,
    treap_search,
    url_filter,
    warc,
    wordpiece,
)
from starloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
