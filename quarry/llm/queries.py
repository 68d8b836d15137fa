"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

import corpus_pipeline

from .decontaminate import op7_decontaminate, op7_sql
from .language import op9_language
from .licenses import op5_licenses
from .lm import op10_lm_score
from .media import op4_media
from .packing import op6_packing
from .pieces import op8_token_counts
from .secrets import op1_secret_scan
from .simhash import op3_simhash
from .toxicity import op2_toxicity

OPERATORS = (op1_secret_scan, op2_toxicity, op3_simhash, op4_media, op5_licenses, op6_packing, op7_decontaminate, op8_token_counts, op9_language, op10_lm_score)
QUERIES = {f.__name__: f for f in OPERATORS} | {"pipeline": corpus_pipeline.run}

SQL = {"op7_decontaminate": op7_sql()}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
