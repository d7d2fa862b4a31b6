"""Streaming form of the gap sessions."""
