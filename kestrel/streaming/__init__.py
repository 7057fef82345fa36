"""Streaming ingestion of reload files (the source project has no streaming operators).

The state-results feeds arrive as a reload log: files are appended, the same key is re-sent,
and "latest row wins" is decided *when the log is read* (``kestrel.plans.reloads``), not at
insert time.  ``ingest_reload_files`` keeps such a log with Structured Streaming: new files in a
landing folder are appended exactly once (the stream's checkpoint records which files were
taken), each row tagged with the file it came from — the tie-break column of the reload order.
"""

from kestrel.streaming.ingest import ingest_reload_files

__all__ = ["ingest_reload_files"]
