"""Readers and writers of tables, side tables and fitted models."""
