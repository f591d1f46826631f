"""Readers: message files, live views, versioned tables, streams, test-table adapters."""
