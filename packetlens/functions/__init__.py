"""Column expressions: envelopes, packet fields, the info text, addresses, averages."""
