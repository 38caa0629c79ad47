"""What the tests here share."""

#: Names that operators use inside.
CLASHING = ["row", "key", "n", "class", "root", "digest", "spans", "words", "items", "score", "part", "bits", "length", "learn", "body", "sign", "rank", "a.b"]
