"""Structured Streaming ingestion of bronze files."""
