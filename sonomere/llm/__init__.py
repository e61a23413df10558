"""Operators for preparing training text, each on documents ``(doc_id, text, ...)``.

Every operator reads the columns it names and ignores all others, whatever they are called.
Nothing outside this package imports it.
"""
