"""Structured Streaming form of the event-tone ingestion (landed day files -> daily tone)."""
