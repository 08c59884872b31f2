"""Training-data operators: mixing, encoding, language, chat, fingerprints, token files,
near-duplicates, vector search, toxicity and secrets. Nothing outside imports this package."""
