"""Training-data operators: decontamination, deduplication, scans, scoring, search and mixing.

Nothing outside this subpackage imports it.  ``registry`` lists its queries and their SQL.
"""
