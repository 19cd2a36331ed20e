"""Training-data operators: mixing, tokens, near copies, languages, chats, secrets, quality, pages."""
