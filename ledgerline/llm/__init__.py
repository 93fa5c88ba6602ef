"""Operators for preparing text for language models. Nothing else imports this package."""
