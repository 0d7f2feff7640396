"""Readers, writers and adapters for tapes, envelopes and landed files."""
