"""The registered queries of this subpackage and the SQL some of them are checked against."""

from __future__ import annotations

from filingloom.llm.hyperminhash import OP11_SQL, op11_hyperminhash_dedup
from filingloom.llm.jaccard import OP3_SQL, op3_jaccard_join
from filingloom.llm.language import op2_language_id
from filingloom.llm.lines import OP8_SQL, op8_line_dedup
from filingloom.llm.mixing import OP9_SQL, op9_mixing_sources
from filingloom.llm.negatives import OP13_SQL, op13_hard_negatives
from filingloom.llm.packing import op5_best_fit_packing
from filingloom.llm.pitmanyor import op10_pitman_yor_score
from filingloom.llm.privacy import op6_private_spans
from filingloom.llm.records import op1_token_records
from filingloom.llm.rules import OP7_SQL, op7_quality_rules
from filingloom.llm.search import OP4_SQL, op4_exact_top_k
from filingloom.llm.turns import op12_repair_turns

QUERIES = {
    f.__name__: f
    for f in (
        op1_token_records, op2_language_id, op3_jaccard_join, op4_exact_top_k, op5_best_fit_packing, op6_private_spans, op7_quality_rules,
        op8_line_dedup, op9_mixing_sources, op10_pitman_yor_score, op11_hyperminhash_dedup, op12_repair_turns, op13_hard_negatives,
    )
}
SQL = {
    "op3_jaccard_join": OP3_SQL, "op4_exact_top_k": OP4_SQL, "op7_quality_rules": OP7_SQL, "op8_line_dedup": OP8_SQL,
    "op9_mixing_sources": OP9_SQL, "op11_hyperminhash_dedup": OP11_SQL, "op13_hard_negatives": OP13_SQL,
}
