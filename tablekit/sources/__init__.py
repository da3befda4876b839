"""Readers (S1-S16) and schema conformance."""
