"""Raw text, payloads, message streams, tables and the city dimension."""
