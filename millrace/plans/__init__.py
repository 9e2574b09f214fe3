"""Ready-made reports over the shared tables, by subject.

Each module holds ``QUERIES``: name -> (function of (spark, folder), SQL that
gives the same rows, or None where SQL cannot).
"""
