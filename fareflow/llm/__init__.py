"""Operators for building training corpora: language, quality, mixing, duplicates, pages, chats, tokens."""
