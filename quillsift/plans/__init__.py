"""Queries over the driver's tables, each beside its SQL."""

from . import artefacts, decisions, details, identity, pages, stages, web  # noqa: F401
from .base import QUERIES, SQL  # noqa: F401
