"""Readers, writers of raw snapshots, and generated inputs."""
