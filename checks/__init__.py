"""Registered queries, the fixture they run on, and their SQL oracles."""
