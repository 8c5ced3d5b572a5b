"""Incremental ingestion with Structured Streaming.

The reference has no streaming operators; its record sources are folders
that grow (one JSON document per CVE, one listing per PoC).  This module runs
the *same* batch operators incrementally over such a folder: a file stream
picks up new documents, and each micro-batch goes through the extraction and
cleaning functions and is appended to a table.  Progress (which files were
seen) lives in the checkpoint location, so a restarted or partially failed
job resumes without reprocessing or losing files.
"""

from riskspan.streaming.ingest import start_cve_ingest

__all__ = ["start_cve_ingest"]
