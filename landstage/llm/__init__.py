"""Operators for preparing training data at scale (the numbered operators and their queries).

Nothing else in the library imports this subpackage; it may import general
helpers of the library.  One module per operator, ``registry`` for the queries
and their SQL, ``common`` for array helpers that run inside Spark tasks.
"""
