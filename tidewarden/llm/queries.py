"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from .classifier import op5_quality_classifier
from .language_model import op6_language_model
from .licenses import OP1_SQL, op1_license_scan
from .mixing import OP3_SQL, op3_mixing
from .neighbours import OP10_SQL, op10_nearest_neighbours
from .packing import op2_packing
from .quality_rules import OP7_SQL, op7_quality_rules
from .sequences import op9_token_output
from .simhash import op4_simhash
from .suffixes import op8_suffix_dedup

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_packing": op2_packing,
    "op3_mixing": op3_mixing,
    "op4_simhash": op4_simhash,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_language_model": op6_language_model,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_token_output": op9_token_output,
    "op10_nearest_neighbours": op10_nearest_neighbours,
}
SQL = {"op1_license_scan": OP1_SQL, "op3_mixing": OP3_SQL, "op7_quality_rules": OP7_SQL, "op10_nearest_neighbours": OP10_SQL}
