"""Operators for preparing training data: quality, duplicates, mixing, licences, tokens, pages, chats, vectors."""
