"""The registered queries of the operators, and their SQL where SQL can express them."""

from .alignment import op11_align
from .decontaminate import OP5_SQL, op5_decontaminate
from .html_text import op4_html_text
from .near_duplicates import op9_near_duplicates
from .packing import op10_pack
from .personal_data import op8_personal_data
from .quality_model import op7_quality
from .quality_rules import OP1_SQL, op1_quality_rules
from .sharding import op12_shards
from .suffix_dedup import OP6_SQL, op6_suffix_dedup
from .tokens import op3_token_counts
from .toxicity import op2_toxicity
from .whitening import op13_whiten

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_token_counts": op3_token_counts,
    "op4_html_text": op4_html_text,
    "op5_decontaminate": op5_decontaminate,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality": op7_quality,
    "op8_personal_data": op8_personal_data,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_pack": op10_pack,
    "op11_align": op11_align,
    "op12_shards": op12_shards,
    "op13_whiten": op13_whiten,
}
ORACLES = {
    "op1_quality_rules": OP1_SQL,
    "op5_decontaminate": OP5_SQL,
    "op6_suffix_dedup": OP6_SQL,
}
