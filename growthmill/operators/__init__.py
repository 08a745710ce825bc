"""Reusable DataFrame operators: staging, joins, touches, funnels, loading and checks."""
