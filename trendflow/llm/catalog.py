"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from trendflow.llm.chat_format import op4_chat_format
from trendflow.llm.embedding_dedup import op1_embedding_dedup
from trendflow.llm.fill_in_middle import FIM_SQL, op13_fill_in_middle
from trendflow.llm.filter_audit import AUDIT_SQL, op11_filter_audit
from trendflow.llm.html_text import op10_html_text
from trendflow.llm.mixing import op8_mixing
from trendflow.llm.ngram_join import op6_ngram_join
from trendflow.llm.packing import op2_packing
from trendflow.llm.passage_dedup import PASSAGE_SQL, op12_passage_dedup
from trendflow.llm.quality_rules import op7_quality_rules
from trendflow.llm.secret_scan import op3_secret_scan
from trendflow.llm.url_filter import op5_url_filter
from trendflow.llm.warc_bundle import WARC_SQL, op9_warc

QUERIES = {f.__name__: f for f in (
    op1_embedding_dedup, op2_packing, op3_secret_scan, op4_chat_format, op5_url_filter, op6_ngram_join,
    op7_quality_rules, op8_mixing, op9_warc, op10_html_text, op11_filter_audit, op12_passage_dedup,
    op13_fill_in_middle)}

ORACLE_SQL: dict[str, str] = {"op9_warc": WARC_SQL, "op11_filter_audit": AUDIT_SQL, "op12_passage_dedup": PASSAGE_SQL,
                              "op13_fill_in_middle": FIM_SQL}
