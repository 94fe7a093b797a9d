"""All queries of the training-data operators (importing the modules registers them)."""

from quarry.llm import op1_urls, op2_near, op3_mix, op4_toxic, op5_quality, op6_shards, op7_pii, op8_decon, op9_lines, op10_lang, op11_trie, op12_diverge, op13_parity  # noqa: F401
from quarry.llm.registry import ORACLE, QUERIES  # noqa: F401
