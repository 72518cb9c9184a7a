"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from fareweather.llm.bpe import op10_bpe
from fareweather.llm.conversations import op12_conversation_repair
from fareweather.llm.divergence import OP11_SQL, op11_source_divergence
from fareweather.llm.forest import op4_embedding_forest
from fareweather.llm.language import op3_language_kernel
from fareweather.llm.maxent import op7_maxent_lm
from fareweather.llm.ngram_join import OP2_SQL, op2_ngram_join
from fareweather.llm.packing import op5_best_fit_packing
from fareweather.llm.passages import op1_quality_mil
from fareweather.llm.rules import op6_quality_rules
from fareweather.llm.secret_scan import op13_secret_scan
from fareweather.llm.substrings import OP8_SQL, op8_substring_dedup
from fareweather.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_quality_mil": op1_quality_mil,
    "op2_ngram_join": op2_ngram_join,
    "op3_language_kernel": op3_language_kernel,
    "op4_embedding_forest": op4_embedding_forest,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_maxent_lm": op7_maxent_lm,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_bpe": op10_bpe,
    "op11_source_divergence": op11_source_divergence,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_secret_scan": op13_secret_scan,
}

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_join": OP2_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op11_source_divergence": OP11_SQL,
}
