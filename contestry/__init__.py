"""Contest analytics on Spark: ingest, clean, star schema, Elo ratings, features.

A contest is one row of "side A met side B, with scores, on a date, in a
competition". Every function takes and returns DataFrames.
"""
