"""Scoring streaming tables with fitted models."""
