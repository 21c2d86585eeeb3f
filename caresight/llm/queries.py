"""The queries of this package, by name, and the SQL for those that SQL can express."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caresight.llm.op10_chat import op10_chat
from caresight.llm.op11_importance import SQL as IMPORTANCE_SQL, op11_importance
from caresight.llm.op12_periodic_runs import op12_periodic_runs
from caresight.llm.op13_packing import op13_packing
from caresight.llm.op1_decontaminate import op1_decontaminate
from caresight.llm.op2_simhash import op2_simhash
from caresight.llm.op3_token_counts import op3_token_counts
from caresight.llm.op4_secrets import SQL as SECRETS_SQL, op4_secrets
from caresight.llm.op5_line_dedup import op5_line_dedup
from caresight.llm.op6_warc import SQL as WARC_SQL, op6_warc
from caresight.llm.op7_quality_rules import op7_quality_rules
from caresight.llm.op8_byte_bpe import op8_byte_bpe
from caresight.llm.op9_quality_classifier import op9_quality_classifier

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_simhash": op2_simhash,
    "op3_token_counts": op3_token_counts,
    "op4_secrets": op4_secrets,
    "op5_line_dedup": op5_line_dedup,
    "op6_warc": op6_warc,
    "op7_quality_rules": op7_quality_rules,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_chat": op10_chat,
    "op11_importance": op11_importance,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_packing": op13_packing,
}
ORACLE: dict[str, str] = {"op4_secrets": SECRETS_SQL, "op6_warc": WARC_SQL, "op11_importance": IMPORTANCE_SQL}
