"""Readers of captured inputs and writers of results."""
