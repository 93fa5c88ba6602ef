"""Readers: dated snapshots, text lines, fixed-width records, rule files."""
