"""Column functions, and the parsing of literal options."""
