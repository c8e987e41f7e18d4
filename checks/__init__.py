"""Test inputs derived from the star-schema tables, and the SQL twins of the registered queries."""
