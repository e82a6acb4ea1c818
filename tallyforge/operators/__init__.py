"""Row, merge, statistics and check operators."""
