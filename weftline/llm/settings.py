"""Parameters of the registered queries."""

SHARDS = 24

# The rules for URLs, as (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

# One of the public tokenizers, by file name.
TOKENIZER = "word_bpe_49k.json"
