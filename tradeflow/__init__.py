"""Batch analytics over marketplace feeds: raw tables, validated tables with quarantine, metrics."""
