"""Operators for preparing language-model training corpora. Nothing else imports this package."""
