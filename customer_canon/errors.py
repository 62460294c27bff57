"""Failures of a whole dataset.

A bad *record* is no exception here: it is a row with a ``reason``. Anything
else that goes wrong (unreadable files, lost storage, a programming error) is
left to surface as the Spark or Python error it is.
"""


class IngestionError(Exception):
    """The dataset as a whole cannot be ingested, e.g. a required column is absent."""
