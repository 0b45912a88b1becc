"""Plain-Python pieces shared by the operator tests."""

import random

SPACE = " \t\n\v\f\r"


def prose(seed: int, n: int = 80) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n)) + "."


def split(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACE:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out + ([word] if word else [])
