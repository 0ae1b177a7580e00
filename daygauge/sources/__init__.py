"""Log scans, SQL text and output writers."""
