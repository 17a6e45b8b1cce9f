"""Row, join, aggregate, window and set operators."""
