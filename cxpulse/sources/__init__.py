"""Input tables: contracts, readers and the behaviour catalogue."""

from .catalog import catalog_from_rows, conform_catalog
from .schemas import SchemaError, conform
from .tables import (
    read,
    read_agent_time,
    read_qa_eval,
    read_qa_flags,
    read_survey,
    read_training_status,
)

__all__ = [
    "catalog_from_rows", "conform_catalog", "SchemaError", "conform",
    "read", "read_agent_time", "read_qa_eval", "read_qa_flags", "read_survey",
    "read_training_status",
]
