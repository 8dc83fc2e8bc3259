"""DataFrame-level operators of the attendance reports."""
