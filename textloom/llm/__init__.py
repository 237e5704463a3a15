"""Operators of a training-data pipeline: tokens, personal data, languages, duplicates, chats, toxicity."""
