"""Readers and writers: raw sources, tiers with manifests, the registry, tensors."""
