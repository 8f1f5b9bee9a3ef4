"""Readers: streams of ticks, tables, payload documents, logs."""
