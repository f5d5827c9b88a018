"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from .bagminhash import op6_near_dedup
from .cotrain import op10_quality
from .decontam import OP3_SQL, op3_decontamination
from .licenses import op5_licenses
from .mixing import op9_mixing
from .periodic import op13_periodic_runs
from .pii import op1_pii
from .repetition import op2_repetition
from .spelling import op12_spelling_variants
from .syncmers import op11_syncmer_fingerprints
from .tokencount import op8_token_counts
from .urlrules import op4_url_rules
from .warc import op7_warc

QUERIES = {f.__name__: f for f in (
    op1_pii, op2_repetition, op3_decontamination, op4_url_rules, op5_licenses, op6_near_dedup, op7_warc, op8_token_counts,
    op9_mixing, op10_quality, op11_syncmer_fingerprints, op12_spelling_variants, op13_periodic_runs)}
ORACLES: dict[str, str] = {"op3_decontamination": OP3_SQL}
