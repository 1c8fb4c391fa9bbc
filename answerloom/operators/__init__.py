"""Table-level operators (``DataFrame -> DataFrame``)."""
