"""What the entry file adds to its queries."""

import corpus_pipeline
from scoreloom.llm.oracle import ORACLE
from scoreloom.llm.queries import QUERIES

LLM_QUERIES = {**QUERIES, "pipeline": corpus_pipeline.run}
LLM_ORACLE = dict(ORACLE)
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
