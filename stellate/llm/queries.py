"""The registered queries of the training-data operators.

The licence scan, MinHash groups, the manifest and the ranked search have an
oracle in SQL.  XXH64 fingerprints, tokenizers, automata, Newton steps,
sketches and backoff weights are beyond it: the tests compare each of those to
a brute-force version, an exact round trip or the library that it must equal.
"""

from __future__ import annotations

from . import fptree, licenses, manifest, minhash
from .bpe import op3_bpe_round_trip
from .chat import op2_chat_format
from .fptree import op13_ranked_search
from .katz import op5_katz_scoring
from .licenses import op4_license_scan
from .manifest import op12_dataset_manifest
from .merkle import op6_document_fingerprints
from .minhash import op11_minhash_near_dedup
from .mixing import op7_mix_sources
from .pii import op10_pii_spans
from .quality import op9_quality_rules
from .repeats import op8_substring_dedup
from .simhash import op1_simhash_near_dedup

QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_chat_format": op2_chat_format,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_license_scan": op4_license_scan,
    "op5_katz_scoring": op5_katz_scoring,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_mix_sources": op7_mix_sources,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_pii_spans": op10_pii_spans,
    "op11_minhash_near_dedup": op11_minhash_near_dedup,
    "op12_dataset_manifest": op12_dataset_manifest,
    "op13_ranked_search": op13_ranked_search,
}
ORACLE_SQL: dict[str, str] = {
    "op4_license_scan": licenses.ORACLE,
    "op11_minhash_near_dedup": minhash.ORACLE,
    "op12_dataset_manifest": manifest.ORACLE,
    "op13_ranked_search": fptree.ORACLE,
}
