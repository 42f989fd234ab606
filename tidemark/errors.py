"""The two user-facing error types: option misuse on read and on write."""


class DataLoaderError(Exception):
    """Raised when a reader is called with options it does not accept."""


class DataWriterError(Exception):
    """Raised for bad writer options or an invalid set of merge clauses."""
