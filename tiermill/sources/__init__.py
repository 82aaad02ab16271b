"""Files, tables and message envelopes."""
