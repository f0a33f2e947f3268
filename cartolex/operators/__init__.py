"""Operators on documents, sections, chunks, references and graphs."""
