"""Registered queries and the composed preparation job."""
