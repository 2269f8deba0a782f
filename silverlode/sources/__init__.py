"""Readers: CSV by header name or by position, file discovery and fingerprints, FX payloads."""
