"""Texts of the tests."""

import random


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("aeioumnrstl") for _ in range(draw.randint(2, 7))) for _ in range(words))


def edge_texts():
    """Nulls, empty and short texts, copies, near copies, shared passages, odd characters, a long text."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.split(" ")
    near[50] = "changed"
    texts = [None, "", " \n\t", "one", "one two three", "ONE two THREE", "é ü ñ", base, base, base.upper(), " ".join(near)]
    texts += [" ".join(near[:110]), f"{prose(3, 40)} {passage}", f"{passage} {prose(4, 50)}", f"{prose(5, 30)}\n{passage}\n{passage}"]
    texts += ["a" * 450, "ab " * 200, "A!! B?? " * 60, "\x0b\x0c x y  z 😀 " * 30, prose(6, 30_000), "x" * 60_000]
    texts += [prose(100 + k, 20 + 7 * k) for k in range(25)]
    return texts
