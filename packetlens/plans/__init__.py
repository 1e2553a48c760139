"""Named jobs and queries, and the SQL they are checked against."""
