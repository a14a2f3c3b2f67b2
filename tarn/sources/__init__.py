"""Readers: message payloads, files, generated data, versioned tables."""
