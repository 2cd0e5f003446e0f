"""Registered queries, the SQL they are checked against, and the inputs both derive."""
