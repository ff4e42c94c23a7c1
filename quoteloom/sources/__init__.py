"""Landed raw payloads -> typed record tables."""
