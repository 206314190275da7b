"""All queries of this folder, each with its SQL where SQL can express it."""

from pulsebook.llm import (  # noqa: F401  (they register their queries)
    exact, interaction, mixing, neardup, packing, pieces, pii, resample, suffix, tokencount, topk, toxicity, wrapper,
)
from pulsebook.llm.common import ORACLES, QUERIES  # noqa: F401
