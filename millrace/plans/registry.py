"""The registered queries and their oracles, by name."""

from __future__ import annotations

from millrace.plans import corpus, evaluation, pairs, records

QUERIES = {**corpus.QUERIES, **pairs.QUERIES, **evaluation.QUERIES, **records.QUERIES}
ORACLES = {**corpus.ORACLES, **pairs.ORACLES, **evaluation.ORACLES, **records.ORACLES}
