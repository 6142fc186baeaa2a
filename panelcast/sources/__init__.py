"""Readers, conforming, storage and the adapters that shape raw tables into canonical frames."""
