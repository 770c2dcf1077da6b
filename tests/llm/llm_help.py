"""Plain versions and odd inputs shared by the tests."""

import random
import re

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return BLANK_WORD.findall(text or "")


def lower(text):
    return (text or "").translate(LETTERS)


def odd_texts(seed=1, n=40):
    """Null, empty, blank, very long, repeated and random texts."""
    draw = random.Random(seed)
    letters = ["a", "B", "cé", "漢字", "d."]
    base = [draw.choice(letters) for _ in range(80)]
    texts = [None, "", " \t\n", "one", "x" * 5000, "a b " * 6000, "line one.\n" * 30, " nb sp", "\n\n"]
    texts += [" ".join(base)] * 4
    for _ in range(n):
        at = draw.randint(0, 40)
        own = [draw.choice(letters) for _ in range(draw.randint(0, 60))]
        texts.append(draw.choice([" ", "\n", "  "]).join(base[at : at + draw.randint(0, 50)] + own))
    return texts
