"""The workflows on streams of records."""
