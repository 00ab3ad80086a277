"""DataFrame-to-DataFrame operators; every one takes explicit key columns."""
