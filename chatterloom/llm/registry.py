"""The queries of this package and what SQL says of them."""

from . import op05_line_dedup
from .op01_quality_rules import op1_quality_rules
from .op02_suffix_dedup import op2_suffix_dedup
from .op03_quality_classifier import op3_quality_classifier
from .op04_embedding_dedup import op4_embedding_dedup
from .op05_line_dedup import op5_line_dedup
from .op06_packing import op6_packing
from .op07_bpe import op7_bpe
from .op08_katz import op8_katz
from .op09_toxicity import op9_toxicity
from .op10_minhash_dedup import op10_minhash_dedup

QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_suffix_dedup, op3_quality_classifier, op4_embedding_dedup, op5_line_dedup, op6_packing, op7_bpe, op8_katz, op9_toxicity, op10_minhash_dedup)}
ORACLES = {"op5_line_dedup": op05_line_dedup.ORACLE_SQL}
