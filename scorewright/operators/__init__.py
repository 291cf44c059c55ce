"""Reusable relational building blocks, all DataFrame-in / DataFrame-out."""
