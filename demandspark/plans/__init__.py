"""Registered queries, composed jobs and the SQL oracle."""
