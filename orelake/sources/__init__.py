"""Sources: stand-in collections over the provided tables, and file readers."""

from orelake.sources.standins import (
    course_documents,
    course_events,
    student_documents,
    user_documents,
)
from orelake.sources.readers import (
    read_extended_json,
    read_jsonl_tolerant,
    read_partition,
    require_rows,
)

__all__ = ["course_documents", "course_events", "read_extended_json", "read_jsonl_tolerant",
           "read_partition", "require_rows", "student_documents", "user_documents"]
