"""Plans that combine operators: the report frames, the stored rollup, the daily job."""
