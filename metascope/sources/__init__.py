"""Landed metadata: page envelopes, and the typed listings made from their records."""
