"""Writers for tables, files and JDBC tables."""
