"""Building blocks of the jobs, all from DataFrame to DataFrame or table."""
