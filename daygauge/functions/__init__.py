"""Column helpers and the reporting clock."""
