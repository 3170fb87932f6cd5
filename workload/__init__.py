"""Binds the library to the test tables: contest feeds, queries and their SQL twins."""
