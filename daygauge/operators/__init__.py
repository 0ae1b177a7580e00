"""DataFrame operators: daily metrics, overlap, retention, leaderboards."""
