"""Queries of the package: opN_<name>(spark, sf_dir) and their DuckDB SQL."""

from __future__ import annotations

from . import op03_mixing, op05_embeddings, op07_jaccard, op10_lm as lm, op13_topk as topk
from .op01_decontamination import op1_decontamination
from .op02_license import op2_license
from .op03_mixing import op3_mixing
from .op04_quality import op4_quality
from .op05_embeddings import op5_embeddings
from .op06_pii import op6_pii
from .op07_jaccard import op7_jaccard
from .op08_langid import op8_langid
from .op09_token_ids import op9_token_ids
from .op10_lm import op10_lm
from .op11_periodic import op11_periodic
from .op12_alignment import op12_alignment
from .op13_topk import op13_topk

QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_license, op3_mixing, op4_quality, op5_embeddings, op6_pii, op7_jaccard, op8_langid,
    op9_token_ids, op10_lm, op11_periodic, op12_alignment, op13_topk)}
ORACLE: dict[str, str] = {"op3_mixing": op03_mixing.SQL, "op5_embeddings": op05_embeddings.SQL,
                          "op7_jaccard": op07_jaccard.SQL, "op10_lm": lm.SQL, "op13_topk": topk.SQL}
