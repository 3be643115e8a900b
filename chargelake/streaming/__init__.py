"""Deliberately empty: the capability set is batch only (see README)."""
