"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from pylonflow.llm.decontaminate import OP1_SQL, op1_decontamination
from pylonflow.llm.divergence import OP13_SQL, op13_source_divergence
from pylonflow.llm.jaccard import OP8_SQL, op8_jaccard_join
from pylonflow.llm.mixing import op7_entropy_mixing
from pylonflow.llm.pii import op5_pii
from pylonflow.llm.negatives import OP12_SQL, op12_hard_negatives
from pylonflow.llm.pieces import op11_piece_encoding
from pylonflow.llm.preferences import OP10_SQL, op10_preference_format
from pylonflow.llm.quality import OP3_SQL, op3_quality_rules
from pylonflow.llm.sharding import OP2_SQL, op2_hash_tree_sharding
from pylonflow.llm.toxicity import op6_toxicity_cnn
from pylonflow.llm.training_order import op9_training_order
from pylonflow.llm.url_filter import op4_url_filter

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_hash_tree_sharding": op2_hash_tree_sharding,
    "op3_quality_rules": op3_quality_rules,
    "op4_url_filter": op4_url_filter,
    "op5_pii": op5_pii,
    "op6_toxicity_cnn": op6_toxicity_cnn,
    "op7_entropy_mixing": op7_entropy_mixing,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_training_order": op9_training_order,
    "op10_preference_format": op10_preference_format,
    "op11_piece_encoding": op11_piece_encoding,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE = {
    "op1_decontamination": OP1_SQL,
    "op2_hash_tree_sharding": OP2_SQL,
    "op3_quality_rules": OP3_SQL,
    "op8_jaccard_join": OP8_SQL,
    "op10_preference_format": OP10_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
