"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from . import ann, centroids, filter_audit, minhash, warc
from .ann import op6_nearest
from .bpe import op2_bpe
from .centroids import op11_centroids
from .filter_audit import op13_filter_audit
from .minhash import op10_minhash
from .mixing import op5_mixing
from .pii import op9_pii
from .quality import op8_quality
from .sharding import op1_sharding
from .spotsigs import op3_spotsigs
from .token_counts import op12_token_counts
from .token_files import op4_token_files
from .warc import op7_warc

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_bpe": op2_bpe,
    "op3_spotsigs": op3_spotsigs,
    "op4_token_files": op4_token_files,
    "op5_mixing": op5_mixing,
    "op6_nearest": op6_nearest,
    "op7_warc": op7_warc,
    "op8_quality": op8_quality,
    "op9_pii": op9_pii,
    "op10_minhash": op10_minhash,
    "op11_centroids": op11_centroids,
    "op12_token_counts": op12_token_counts,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op6_nearest": ann.ORACLE,
    "op7_warc": warc.ORACLE,
    "op10_minhash": minhash.ORACLE,
    "op11_centroids": centroids.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
