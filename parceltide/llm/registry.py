"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parceltide.llm import op3_neighbours, op5_mixing, op8_warc
from parceltide.llm.op1_licenses import op1_licenses
from parceltide.llm.op2_secrets import op2_secrets
from parceltide.llm.op4_jaccard import op4_jaccard
from parceltide.llm.op6_decontaminate import op6_decontaminate
from parceltide.llm.op7_shards import op7_shards
from parceltide.llm.op9_toxicity import op9_toxicity
from parceltide.llm.op10_extract import op10_extract
from parceltide.llm.op11_spelling import op11_spelling
from parceltide.llm.op12_infill import op12_infill
from parceltide.llm.op13_simhash import op13_simhash

_QUERIES = [
    op1_licenses, op2_secrets, op3_neighbours.op3_neighbours, op4_jaccard, op5_mixing.op5_mixing,
    op6_decontaminate, op7_shards, op8_warc.op8_warc, op9_toxicity, op10_extract,
    op11_spelling, op12_infill, op13_simhash,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_neighbours": op3_neighbours.ORACLE_SQL, "op5_mixing": op5_mixing.ORACLE_SQL,
            "op8_warc": op8_warc.ORACLE_SQL}
