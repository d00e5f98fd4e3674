"""Registered queries over the test tables, each with its SQL twin where SQL can express it."""

from . import features, ingest, models, reports, stages  # noqa: F401  (registers the queries)
from .registry import ORACLES, QUERIES  # noqa: F401
