"""Sources and sinks: files, catalog and JDBC tables, queries, partitioned extraction."""
