"""The registered queries, each with the SQL that checks it."""

from workload import events, keys, quality, text  # noqa: F401
from workload.registry import QUERIES, SQL  # noqa: F401
