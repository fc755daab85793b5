"""Readers for tables, messages, change data and delimited logs."""
