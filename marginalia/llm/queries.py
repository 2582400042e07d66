"""The registered queries of this subpackage, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from .conversation import op11_conversation_repair
from .exactdedup import OP13_SQL, op13_exact_dedup
from .hardneg import OP12_SQL, op12_hard_negatives
from .knn import OP9_SQL, op9_topk
from .langid import op6_langid
from .linededup import OP4_SQL, op4_line_dedup
from .lm import op1_lm_score
from .matroska import op8_matroska
from .mixing import OP2_SQL, op2_mixing
from .packing import op10_packing
from .sharding import op7_sharding
from .simhash import op3_simhash
from .toxicity import op5_toxicity

QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_line_dedup": op4_line_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_langid": op6_langid,
    "op7_sharding": op7_sharding,
    "op8_matroska": op8_matroska,
    "op9_topk": op9_topk,
    "op10_packing": op10_packing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE_SQL = {"op2_mixing": OP2_SQL, "op4_line_dedup": OP4_SQL, "op9_topk": OP9_SQL, "op12_hard_negatives": OP12_SQL, "op13_exact_dedup": OP13_SQL}
