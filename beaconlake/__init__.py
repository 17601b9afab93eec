"""Typed tables and analytics over raw payloads of public monitoring feeds."""
