"""DataFrame -> DataFrame operators."""

from orelake.operators.dedupe import latest_by_key
from orelake.operators.watermark import Cursor, advance, incremental_scan, next_watermark
from orelake.operators.latest import keep_latest
from orelake.operators.lookup import email_by_key, lookup_email

__all__ = ["Cursor", "advance", "email_by_key", "incremental_scan", "keep_latest", "latest_by_key",
           "lookup_email", "next_watermark"]
