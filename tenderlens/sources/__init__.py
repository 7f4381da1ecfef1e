"""Readers and writers: landed JSON pages, CSV, stored runs, model tables."""
