"""Checked queries: each operator over the test tables, beside the SQL that must give the same rows."""
