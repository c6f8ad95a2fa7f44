"""Readers, schemas, and tables kept between stages."""
