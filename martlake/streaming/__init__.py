"""Incremental landing of the source files.

The source package is static files; there is no windowed, watermarked or
stateful stream logic to rebuild.  The only streaming piece is the bronze
landing (S3) expressed with Structured Streaming's file source, so new CSV
drops are landed exactly once with progress kept in a checkpoint folder
(which must be a shared, durable path on a cluster).
"""

from martlake.streaming.landing import land_stream  # noqa: F401
