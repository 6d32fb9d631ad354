"""Readers that turn landed files and responses into typed rows."""
