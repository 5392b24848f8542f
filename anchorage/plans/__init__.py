"""Operators composed into the clinical dataset plans."""
