"""Queries on the test tables and their SQL twins (see ``__spark_entry__``)."""
