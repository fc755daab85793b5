"""Streams: running them, stateful processors, lookups and ordering."""
