"""Operators for large training corpora: documents in, verdicts, spans and tokens out."""
