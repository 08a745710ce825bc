"""Landed payloads to bronze rows, and the contracts of the bronze tables."""
