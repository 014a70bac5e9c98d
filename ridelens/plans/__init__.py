"""Composite plans (C1-C7), report frames and the fixture views."""
