"""Structured Streaming operators (sources, alert stream, landing, curation)."""
