"""Registered queries over the shared test tables and the SQL they must agree with."""
