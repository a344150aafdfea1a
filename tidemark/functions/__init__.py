"""Column functions: event decoding and encoding, change events, schema text, event time."""
