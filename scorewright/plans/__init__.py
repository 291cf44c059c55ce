"""User-level jobs (SURVEY I)."""
