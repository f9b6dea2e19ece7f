"""Readers and writers of logs, outboxes, rule sets and sink tables."""
