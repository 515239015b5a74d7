"""Readers, generators and writers."""
