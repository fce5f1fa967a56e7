"""Texts that tokenizers trip over."""

TEXTS = [
    "123 MAIN ST",
    None,
    "",
    " ",
    "ATTN 123 MAIN ST",
    "123 OLD MAIN ST N",
    "nope",
    "ÉCOLE 12",
    "#12A",
    "Brand#7 7#",
    "25-24-1-W5",
    "t2x-1v4 H2X_1V4 h2x1v4",
    "-",
    "'",
    "o'neil mary-ann",
    "a\t\nb",
    "x y   z",
    " ",
    " 12 LANE ST ",
    "RTE RTE.9 http://x",
    "70.23.22.57",
    "ALPHA_NUM POBOX A.1 É1a",
    "12 MAIN MAIN RD ST",
    "1 A ST 2 B ST",
    "\x0b\x0b a\x0bb",
    "the la La ALLÉE NORD-EST CUL DE SAC",
    "123 MAIN ST",
    "--- -1- 1-'a",
]
