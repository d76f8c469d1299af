"""The queries of this subpackage, by name, and SQL that gives the same rows where there is any."""

from __future__ import annotations

import corpus_pipeline
from perigee.llm.chat import OP10_SQL, op10_chat
from perigee.llm.decontaminate import OP8_SQL, op8_decontaminate
from perigee.llm.jaccard import OP3_SQL, op3_near_documents
from perigee.llm.language import op2_language
from perigee.llm.lines import op9_lines
from perigee.llm.merkle import OP13_SQL, op13_merkle
from perigee.llm.mixing import OP1_SQL, op1_mix
from perigee.llm.pages import op7_pages
from perigee.llm.private import op6_private
from perigee.llm.quality import OP5_SQL, op5_quality
from perigee.llm.scoring import op4_score
from perigee.llm.search import OP11_SQL, op11_search
from perigee.llm.sketches import OP12_SQL, op12_odd_sketches

QUERIES = {
    "op1_mix": op1_mix,
    "op2_language": op2_language,
    "op3_near_documents": op3_near_documents,
    "op4_score": op4_score,
    "op5_quality": op5_quality,
    "op6_private": op6_private,
    "op7_pages": op7_pages,
    "op8_decontaminate": op8_decontaminate,
    "op9_lines": op9_lines,
    "op10_chat": op10_chat,
    "op11_search": op11_search,
    "op12_odd_sketches": op12_odd_sketches,
    "op13_merkle": op13_merkle,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op1_mix": OP1_SQL,
    "op3_near_documents": OP3_SQL,
    "op5_quality": OP5_SQL,
    "op8_decontaminate": OP8_SQL,
    "op10_chat": OP10_SQL,
    "op11_search": OP11_SQL,
    "op12_odd_sketches": OP12_SQL,
    "op13_merkle": OP13_SQL,
} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
