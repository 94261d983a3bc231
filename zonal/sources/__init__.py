"""Readers and writers: locations, tiles, layer catalogue, results."""
