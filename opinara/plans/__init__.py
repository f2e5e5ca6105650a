"""Registered queries: operators applied to the test tables, each with its SQL twin."""
