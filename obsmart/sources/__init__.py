"""Raw tables: declared schemas, landing, reading, JDBC and seeds."""
