"""The corpus operators' registered queries and their oracle texts."""

from __future__ import annotations

from starloom.llm.ann import op3_ann
from starloom.llm.chaining import op9_chaining
from starloom.llm.knn import OP5_SQL, op5_knn
from starloom.llm.language_id import op1_language_id
from starloom.llm.line_dedup import OP8_SQL, op8_line_dedup
from starloom.llm.mixing import op10_mixing
from starloom.llm.packing import op6_packing
from starloom.llm.pattern_packing import op13_pattern_packing
from starloom.llm.periodic import op12_periodic
from starloom.llm.simhash import op2_simhash
from starloom.llm.spelling import op11_spelling
from starloom.llm.suffix_dedup import op4_suffix_dedup
from starloom.llm.warc import OP7_SQL, op7_warc

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_simhash": op2_simhash,
    "op3_ann": op3_ann,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_knn": op5_knn,
    "op6_packing": op6_packing,
    "op7_warc": op7_warc,
    "op8_line_dedup": op8_line_dedup,
    "op9_chaining": op9_chaining,
    "op10_mixing": op10_mixing,
    "op11_spelling": op11_spelling,
    "op12_periodic": op12_periodic,
    "op13_pattern_packing": op13_pattern_packing,
}

#: The others have no SQL form, or none that is fit for whole tables: tests hold them against plain versions.
ORACLE_SQL = {
    "op5_knn": OP5_SQL,
    "op7_warc": OP7_SQL,
    "op8_line_dedup": OP8_SQL,
}
