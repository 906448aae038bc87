"""Streaming use of the audit.

Rules are stateless row expressions, so the same evaluation runs unchanged on
a streaming DataFrame: no watermark, no state store, append output.
"""

from recordcheck.streaming.audit_stream import audit_stream, start_audit_stream

__all__ = ["audit_stream", "start_audit_stream"]
