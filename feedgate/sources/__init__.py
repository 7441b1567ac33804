"""Readers: feeds, manifests, error output and the target table."""
