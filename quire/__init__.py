"""Spark jobs that turn a growing snapshot of scholarly records into a searchable vector corpus."""
