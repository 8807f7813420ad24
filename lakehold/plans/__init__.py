"""Composite plans: marts, health reports, and the role mapping onto the test tables."""
