"""Parameters of the registered queries."""

#: The rules of the URL query: (verdict, host, path).
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

#: The model file of the piece query.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
