"""Operators for preparing training data: tokens, mixing, near copies, search.

Each module holds one operator with its own general interface; ``queries`` binds
them to the test tables.  Intermediate tables are written below the folder named
by ``spark.checkpoint.dir``, so a lost executor costs a re-read and nothing else.
"""
