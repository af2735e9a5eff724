"""End-to-end jobs composed from operators, and the query registry."""
