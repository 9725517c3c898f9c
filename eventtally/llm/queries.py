"""The registered queries of this package and their SQL."""

from __future__ import annotations

from eventtally.llm.common import ORACLES, QUERIES, Query


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """Both tables, after all operator modules have been read."""
    from eventtally.llm import (  # noqa: F401
        byte_bpe,
        chat_format,
        decontaminate,
        jaccard_join,
        language_id,
        lm_score,
        packing,
        phrases,
        pii,
        spelling,
        topk,
        url_reputation,
        warc,
    )

    return QUERIES, ORACLES
