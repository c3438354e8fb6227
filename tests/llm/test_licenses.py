"""License scan against a slow scan of all windows, and on whole license texts."""

from __future__ import annotations

import random
import re

import pytest

from tabforge.llm import licenses

WORD = re.compile(r"\w+")


def common(x: list[str], y: list[str]) -> int:
    row = [0] * (len(y) + 1)
    for w in x:
        corner = 0
        for j, v in enumerate(y, 1):
            corner, row[j] = row[j], corner + 1 if w == v else max(row[j], row[j - 1])
    return row[-1]


def every_window(words: list[str], tmpl: list[str], coverage: float) -> list[tuple[int, int]]:
    """All stretches of the text that align with enough of the template's words and little else."""
    n, out = len(tmpl), []
    for a in range(len(words)):
        for b in range(a + 1, min(len(words), a + int(n / coverage) + 1) + 1):
            k = common(words[a:b], tmpl)
            if k >= coverage * n - 1e-9 and k >= coverage * (b - a) - 1e-9:
                out.append((a, b))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_scan_finds_what_a_scan_of_all_windows_finds(seed):
    """Random texts with notices in them, with some words lost, changed or put in between."""
    rng = random.Random(seed)
    vocab = [f"w{i}" + "x" * rng.randrange(6) for i in range(30)]
    templates = [("A", " ".join(rng.choices(vocab, k=12))), ("B", " ".join(rng.sample(vocab, 9)))]
    scanner = licenses.Scanner(templates)
    found = missed = 0
    for _ in range(60):
        words = rng.choices(vocab, k=rng.randrange(0, 25))
        for _, text in rng.sample(templates, rng.randrange(3)):
            notice = text.split()
            for _ in range(rng.randrange(3)):
                i = rng.randrange(len(notice))
                rng.choice([lambda: notice.pop(i), lambda: notice.insert(i, "odd"), lambda: notice.__setitem__(i, "odd")])()
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        text = " ".join(words)
        spans = [m.span() for m in WORD.finditer(text)]
        got = scanner.scan(text)
        slow = {name: every_window(words, t.split(), 0.8) for name, t in templates}
        for name, start, end, matched, n, share in got:  # each is one of the windows
            a, b = [s for s, _ in spans].index(start), [e for _, e in spans].index(end) + 1
            assert (a, b) in slow[name] and matched <= common(words[a:b], dict(templates)[name].split()) and share == matched / n
        taken = [(s, e) for _, s, e, *_ in got]
        assert all(x[1] <= y[0] for x, y in zip(taken, taken[1:]))
        for name, windows in slow.items():  # where there is a window, a notice of it or one that overlaps it is found
            for a, b in windows:
                hit = any(s < spans[b - 1][1] and e > spans[a][0] for s, e in taken)
                found, missed = found + hit, missed + (not hit)
    assert found > 50 and missed <= 0.02 * found


@pytest.mark.parametrize("name", ["MIT", "ISC", "BSD"])
def test_whole_license_texts(name):
    """A whole text is one notice of its full length, with one word in fifteen changed and others around it."""
    whole = max((t for n, t in licenses.TEMPLATES if n == name), key=len)
    words = whole.split()
    assert len(words) > 100
    scan = licenses.Scanner().scan
    rng = random.Random(name)
    for changed, least in ((0, 1.0), (len(words) // 15, 0.8)):
        some = list(words)
        for i in rng.sample(range(len(some)), changed):
            some[i] = "changed"
        text = "Copyright 2020 somebody else.\n\n" + " ".join(some) + "\n\nint main() { return 0; }"
        got = scan(text)
        assert [g[0] for g in got] == [name] and got[0][5] >= least
        assert got[0][1] <= 60 and got[0][2] >= len(text) - 60


def test_two_whole_texts_and_a_notice_in_one_file():
    mit, bsd = (max((t for n, t in licenses.TEMPLATES if n == k), key=len) for k in ("MIT", "BSD"))
    text = "a b c\n" + mit + "\n" + "word " * 50 + "All rights reserved.\n" + bsd
    assert [g[0] for g in licenses.Scanner().scan(text)] == ["MIT", "all-rights-reserved", "BSD"]
