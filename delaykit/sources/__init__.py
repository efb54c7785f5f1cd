"""Readers and writers. Every external system is a Spark ``format`` name."""
