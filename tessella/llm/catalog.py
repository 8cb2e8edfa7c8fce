"""The corpus operators' queries and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from tessella.llm.conversations import OP13_SQL, op13_conversation_repair
from tessella.llm.decontamination import OP7_SQL, op7_decontamination
from tessella.llm.fingerprints import op11_fingerprints
from tessella.llm.html_extraction import op1_html_extraction
from tessella.llm.language_model import op4_language_model
from tessella.llm.near_duplicates import op9_near_duplicates
from tessella.llm.packing import op3_packing
from tessella.llm.pii import op10_pii
from tessella.llm.quality_classifier import op5_quality_classifier
from tessella.llm.quality_rules import OP6_SQL, op6_quality_rules
from tessella.llm.sharding import op2_sharding
from tessella.llm.spelling import OP12_SQL, op12_spelling_variants
from tessella.llm.token_tables import op8_token_table


def queries() -> dict:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_sharding": op2_sharding,
        "op3_packing": op3_packing,
        "op4_language_model": op4_language_model,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_quality_rules": op6_quality_rules,
        "op7_decontamination": op7_decontamination,
        "op8_token_table": op8_token_table,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_pii": op10_pii,
        "op11_fingerprints": op11_fingerprints,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_conversation_repair": op13_conversation_repair,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    found = {"op6_quality_rules": OP6_SQL, "op7_decontamination": OP7_SQL, "op12_spelling_variants": OP12_SQL, "op13_conversation_repair": OP13_SQL}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
