"""Reading raw files, zones of tables, the warehouse catalog, JDBC."""
