"""Operations of a training-data pipeline. Importing this registers their queries."""

from charlake.llm import decontamination, fuzzy_lines, language, ngram_join, packing, phrases, pii, quality, ranking, sharding, token_files, toxicity, warc  # noqa: F401
from charlake.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
