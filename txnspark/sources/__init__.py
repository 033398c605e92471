"""Readers for tables, files, Kafka topics and JDBC tables."""
