"""Sources and sinks: corpus tables, crawl-output JSON files, stored indexes."""
