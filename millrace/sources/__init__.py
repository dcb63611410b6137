"""Readers, writers and frozen resources."""
