"""Named end-to-end queries and the SQL they are checked against."""
