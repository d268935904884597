"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from quantspark.llm.bpe import op4_byte_bpe
from quantspark.llm.chat import op8_chat_round_trip
from quantspark.llm.conversation_repair import op11_conversation_repair
from quantspark.llm.fingerprints import op13_document_fingerprints
from quantspark.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from quantspark.llm.jaccard import OP5_SQL, op5_jaccard_components
from quantspark.llm.language_model import op6_kneser_ney
from quantspark.llm.licenses import op1_license_scan
from quantspark.llm.packing import op2_pattern_packing
from quantspark.llm.quality import op9_isolation_rules
from quantspark.llm.sharding import op7_feistel_shards
from quantspark.llm.toxicity import op3_weak_supervision
from quantspark.llm.topk import OP10_SQL, op10_threshold_top_k

QUERIES = {f.__name__: f for f in (op1_license_scan, op2_pattern_packing, op3_weak_supervision, op4_byte_bpe, op5_jaccard_components, op6_kneser_ney, op7_feistel_shards, op8_chat_round_trip, op9_isolation_rules, op10_threshold_top_k, op11_conversation_repair, op12_hard_negatives, op13_document_fingerprints)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES = {"op5_jaccard_components": OP5_SQL, "op10_threshold_top_k": OP10_SQL, "op12_hard_negatives": OP12_SQL}
