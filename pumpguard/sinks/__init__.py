"""Writers: tables, partitioned layouts, compaction, JDBC, alert messages."""
