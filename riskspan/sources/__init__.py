"""Sources and sinks: file scans, nested-document parsers, score lookups."""
