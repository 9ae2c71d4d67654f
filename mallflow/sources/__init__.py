"""Readers and writers: text files, date-partitioned tables, message streams and the metric store."""
