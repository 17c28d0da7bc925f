"""Names, types and patterns."""
