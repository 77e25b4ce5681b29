"""The registered queries of the corpus operators, and their SQL where it can say the same."""

from __future__ import annotations

from tarmaq.llm.chat_format import op5_chat_format
from tarmaq.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from tarmaq.llm.jaccard_join import op3_ngram_jaccard
from tarmaq.llm.quality_rules import OP7_SQL, op7_quality_rules
from tarmaq.llm.sentence_pieces import op9_sentence_pieces
from tarmaq.llm.source_mix import OP2_SQL, op2_source_mix
from tarmaq.llm.substring_dedup import op1_substring_dedup
from tarmaq.llm.suffix_dedup import op8_suffix_array_dedup
from tarmaq.llm.surrogates import op10_pii_surrogates
from tarmaq.llm.token_records import op13_token_records
from tarmaq.llm.turn_repair import op12_turn_repair
from tarmaq.llm.warc import op6_warc
from tarmaq.llm.winnowing import op4_winnowing

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_source_mix": op2_source_mix,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_winnowing": op4_winnowing,
    "op5_chat_format": op5_chat_format,
    "op6_warc": op6_warc,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_sentence_pieces": op9_sentence_pieces,
    "op10_pii_surrogates": op10_pii_surrogates,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_turn_repair": op12_turn_repair,
    "op13_token_records": op13_token_records,
}

ORACLE_SQL: dict[str, str] = {
    "op2_source_mix": OP2_SQL,
    "op7_quality_rules": OP7_SQL,
    "op11_hard_negatives": OP11_SQL,
}
