"""Registered queries over the given tables, each with its SQL where one exists."""

from shelfwise.queries import (  # noqa: F401
    cleaning,
    evaluation,
    features,
    profile,
    relational,
    sampling,
    storage,
    training,
)
from shelfwise.queries.registry import QUERIES, SQL  # noqa: F401
