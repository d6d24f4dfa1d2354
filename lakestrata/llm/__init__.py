"""Training-data operators: search, deduplication, language, tokens, decontamination, privacy, secrets.

Nothing else in the library imports this subpackage. ``queries.py`` holds the registered queries.

Rules shared by all operators:

* An operator reads only the columns it is told to read and returns the id column plus its own result
  columns, so extra input columns can never clash with its results.
* A null text counts as an empty text unless the operator's docstring says otherwise.
* Intermediate tables live below ``spark.checkpoint.dir`` (shared); ``localCheckpoint`` is never used.
"""
