"""Catalogue and review analytics, feature building and classification on Spark."""
