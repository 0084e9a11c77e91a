"""Headway: punctuality analytics over public-transport realtime feeds, as PySpark DataFrame functions."""
