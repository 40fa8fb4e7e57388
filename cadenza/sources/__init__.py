"""Landed JSON responses to typed raw rows."""
