"""Readers and writers: relations, annotation documents, tracking files, footprints."""
