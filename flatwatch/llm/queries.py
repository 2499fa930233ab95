"""The corpus operators as registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flatwatch.llm.best_fit_reduction import op1_best_fit_reduction
from flatwatch.llm.conversation_trie import op13_conversation_trie
from flatwatch.llm.cutting_stock import op12_cutting_stock
from flatwatch.llm.fragment_alignment import op11_fragment_alignment
from flatwatch.llm.kneser_ney_tox import op7_kneser_ney_tox
from flatwatch.llm.naive_bayes_lang import op9_naive_bayes_lang
from flatwatch.llm.neighbour_votes import op2_neighbour_votes
from flatwatch.llm.packed_ids import op6_packed_ids
from flatwatch.llm.path_templates import op4_path_templates
from flatwatch.llm.qgram_decontam import op8_qgram_decontam
from flatwatch.llm.rule_ledger import OP3_SQL, op3_rule_ledger
from flatwatch.llm.sentence_spans import op10_sentence_spans
from flatwatch.llm.simhash_ball import op5_simhash_ball

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_best_fit_reduction, op2_neighbour_votes, op3_rule_ledger, op4_path_templates, op5_simhash_ball,
        op6_packed_ids, op7_kneser_ney_tox, op8_qgram_decontam, op9_naive_bayes_lang, op10_sentence_spans,
        op11_fragment_alignment, op12_cutting_stock, op13_conversation_trie)}

ORACLES: dict[str, str] = {"op3_rule_ledger": OP3_SQL}
