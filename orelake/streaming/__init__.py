"""Structured Streaming: course-event feed to bronze, de-duplication, keyed upsert."""
