"""The queries of the subpackage, one per operator, and the DuckDB SQL of those
that SQL can express."""

from __future__ import annotations

from sparkmine.llm.collocations import OP12_SQL, op12_collocations
from sparkmine.llm.decontaminate import op2_decontaminate
from sparkmine.llm.fingerprints import OP11_SQL, op11_fingerprints
from sparkmine.llm.jaccard_join import op6_jaccard_join
from sparkmine.llm.licenses import op5_license_scan
from sparkmine.llm.mixing import OP9_SQL, op9_mixing
from sparkmine.llm.periodic_runs import OP13_SQL, op13_periodic_runs
from sparkmine.llm.quality import OP1_SQL, op1_quality_rules
from sparkmine.llm.sharding import op8_sharding
from sparkmine.llm.substring_dedup import op3_substring_dedup
from sparkmine.llm.token_counts import op7_token_counts
from sparkmine.llm.toxicity import op10_toxicity
from sparkmine.llm.training_order import op4_training_order

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontaminate": op2_decontaminate,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_training_order": op4_training_order,
    "op5_license_scan": op5_license_scan,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_token_counts": op7_token_counts,
    "op8_sharding": op8_sharding,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_fingerprints": op11_fingerprints,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op1_quality_rules": OP1_SQL,
    "op9_mixing": OP9_SQL,
    "op11_fingerprints": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_periodic_runs": OP13_SQL,
}
