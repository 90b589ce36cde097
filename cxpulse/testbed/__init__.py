"""Testbed: logical inputs derived from the driver's synthetic tables, the
registered queries, and their independent SQL oracle."""
