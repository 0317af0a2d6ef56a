"""Operators for preparing training text: mixing, near copies, chat, quality, personal data, rules, search, URLs, pieces."""
