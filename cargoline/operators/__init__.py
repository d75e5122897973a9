"""Row-level operators, each a ``DataFrame -> DataFrame`` function."""
