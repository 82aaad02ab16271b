"""The ratings stream: envelopes to bronze."""
