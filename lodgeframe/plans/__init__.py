"""The gold tables and their reports."""
