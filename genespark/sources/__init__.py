"""Readers and writers of annotation file formats."""
