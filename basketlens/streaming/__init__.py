"""Incremental ingest (I1 -> I14 as a Structured Streaming job).

The reference has no streaming operator; this module only runs the same
raw-file reader and table writer incrementally, so that new export files
dropped into a folder are appended to the hand-off table exactly once
(file-source bookkeeping and sink commit log live in ``checkpoint``).
"""

from basketlens.streaming.ingest import ingest_raw_files  # noqa: F401
