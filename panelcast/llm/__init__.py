"""Operators for preparing training text at scale: deduplication, tokens, licences, packing, chats, languages, shards."""
