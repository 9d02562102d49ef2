"""All queries of the core library and their SQL."""

from linkloom.queries import joins, more, ranking, states, texts  # noqa: F401
from linkloom.queries.base import QUERIES, SQL  # noqa: F401
