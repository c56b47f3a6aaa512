"""Readers. Every reader has an explicit schema."""
