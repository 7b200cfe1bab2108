"""Queries of this subpackage, by the names under which they are registered."""

from __future__ import annotations

from tidemark.llm.centroids import op13_centroids
from tidemark.llm.collocations import op11_collocations
from tidemark.llm.exact_dedup import op12_exact_dedup
from tidemark.llm.minhash import op9_minhash
from tidemark.llm.mixing import op7_mixing
from tidemark.llm.oracles import CENTROIDS, COLLOCATIONS, EXACT, QUALITY
from tidemark.llm.packing import op5_packing
from tidemark.llm.pii import op10_pii
from tidemark.llm.quality import op1_quality
from tidemark.llm.secrets import op6_secrets
from tidemark.llm.sharding import op8_sharding
from tidemark.llm.simhash import op4_simhash
from tidemark.llm.token_counts import op2_token_counts
from tidemark.llm.token_files import op3_token_files

QUERIES = {
    "op1_quality": op1_quality,
    "op2_token_counts": op2_token_counts,
    "op3_token_files": op3_token_files,
    "op4_simhash": op4_simhash,
    "op5_packing": op5_packing,
    "op6_secrets": op6_secrets,
    "op7_mixing": op7_mixing,
    "op8_sharding": op8_sharding,
    "op9_minhash": op9_minhash,
    "op10_pii": op10_pii,
    "op11_collocations": op11_collocations,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_centroids": op13_centroids,
}

ORACLE_SQL: dict[str, str] = {"op1_quality": QUALITY, "op11_collocations": COLLOCATIONS, "op12_exact_dedup": EXACT, "op13_centroids": CENTROIDS}
