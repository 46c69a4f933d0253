"""Every registered query and, where SQL can say it, the independent check."""

from __future__ import annotations

from intentloom.plans import evaluation, monitoring, quality, sampling, sources, streams, text, training

PARTS = (sources, quality, sampling, text, evaluation, training, monitoring, streams)
QUERIES = {name: fn for part in PARTS for name, fn in part.QUERIES.items()}
ORACLE = {name: sql for part in PARTS for name, sql in part.ORACLE.items()}
