"""What the grid of windows finds of the passages that any window, of every start and length, would find."""

from __future__ import annotations

import random

from cohortloom.llm import license_scan


def reached(words, x, starts, lengths):
    """Whether one of these windows reaches the threshold with the template."""
    pairs, known = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)], set(x.pairs)
    for i in starts:
        for n in lengths:
            window = pairs[i : i + n]
            if window and set(x.required) <= set(words[i : i + n + 1]):
                distinct = set(window)
                if 10 * len(distinct & known) >= 4 * (len(distinct) + len(known)):
                    return True
    return False


def passage(rnd, x):
    """The template with some words dropped, changed and put in, among others."""
    share, out = rnd.choice([0.0, 0.03, 0.06, 0.1]), []
    for w in x.words:
        kind = rnd.random()
        out += [] if kind < share / 3 else ["zz%d" % rnd.randint(0, 99)] if kind < 2 * share / 3 and not w.isdigit() else [w, "yy"] if kind < share else [w]
    other = lambda n: [f"qq{rnd.randint(0, 500)}" for _ in range(n)]
    return other(rnd.randint(0, 9)) + out + other(rnd.randint(0, 9))


def test_recall_of_the_windows():
    rnd = random.Random(8)
    short = [x for x in license_scan.default_templates() if len(x.words) <= 200]
    there = found = 0
    for _ in range(12):
        for x in short:
            words = passage(rnd, x)
            n, b = len(words), len(x.words)
            some = range(1, 2 * b) if b <= 40 else range(b // 2, 2 * b, 3)
            if reached(words, x, range(n) if b <= 40 else range(0, 12), some):
                there += 1
                starts = [i for i in range(n - 1) if f"{words[i]} {words[i + 1]}" in set(x.pairs)] if x.step == 1 else range(0, n, x.step)
                found += reached(words, x, starts, x.lengths)
    assert there > 300 and found >= 0.95 * there, (found, there)
    print(f"recall {found} of {there}")
