"""Readers: listings, manifests, ledgers, staged files, page histories."""
