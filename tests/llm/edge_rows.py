"""Texts that every text operator has to cope with."""

EDGE_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "Eins zwei drei vier"),
    (4, "Eins zwei drei vier"),
    (5, "Eins zwei drei vier"),
    (None, "no id here"),
    (None, None),
    (6, "été 日本語 \U0001f600 ẞ İ Σ"),
    (7, "wort " * 30_000),
    (8, "x"),
]
