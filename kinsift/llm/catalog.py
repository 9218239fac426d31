"""Queries of the training-data operators."""

from __future__ import annotations

from kinsift.llm.edit_screen import op6_edit_screen
from kinsift.llm.hash_tree import op4_hash_tree
from kinsift.llm.near_forest import op5_near_forest
from kinsift.llm.oracle import ORACLE_SQL as ORACLE_SQL
from kinsift.llm.parsed_repeats import op2_parsed_repeats
from kinsift.llm.piece_codec import op7_piece_codec
from kinsift.llm.ratio_svm import op1_ratio_svm
from kinsift.llm.risk_rules import op8_risk_rules
from kinsift.llm.template_lines import op3_template_lines
from kinsift.llm.token_store import op10_token_store
from kinsift.llm.warc_derive import op9_warc_derive

QUERIES = {f.__name__: f for f in (op1_ratio_svm, op2_parsed_repeats, op3_template_lines, op4_hash_tree, op5_near_forest, op6_edit_screen, op7_piece_codec, op8_risk_rules, op9_warc_derive, op10_token_store)}
