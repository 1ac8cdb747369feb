"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")


def edit_distance(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def components(nodes, links) -> dict:
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text: str | None, n: int) -> set:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def near_duplicates(docs: dict, n: int, percent: int = 80) -> dict:
    sets = {k: shingles(t, n) for k, t in docs.items()}
    links = []
    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    return {k: (len(sets[k]), c) for k, c in components(sets, links).items()}


def near_lines(docs: list[tuple], most: int = 2, chars: int = 20) -> dict:
    seen = [(k, i, line.strip()) for k, t in docs for i, line in enumerate((t or "").split("\n")) if line.strip()]
    lines = sorted({line for *_, line in seen})
    links = [
        (a, b)
        for x, a in enumerate(lines)
        for b in lines[x + 1 :]
        if abs(len(a) - len(b)) <= most and edit_distance(a, b) <= min(most, min(len(a), len(b)) // chars)
    ]
    degree, group = Counter(x for pair in links for x in pair), components(lines, links)
    first: dict = {}
    for k, i, line in sorted(seen, key=lambda s: (s[0] is None, s[0] or 0, s[1])):
        first.setdefault(group[line], (k, i))
    return {(k, i): (degree[line], *first[group[line]], first[group[line]] == (k, i)) for k, i, line in seen}


def measures(text: str | None) -> tuple:
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


def repeated_bytes(docs: list[tuple], width: int) -> dict:
    where = defaultdict(set)
    for k, t in docs:
        data = (t or "").encode()
        for i in range(len(data) - width + 1):
            where[data[i : i + width]].add(k)
    found = {}
    for k, t in docs:
        data = (t or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - width + 1):
            if min(where[data[i : i + width]]) < k:
                gone[i : i + width] = [True] * width
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found[k] = (len(data), sum(gone), runs, bytes(c for c, g in zip(data, gone) if not g))
    return found


def contains(text: str | None, item: str, share: float = 0.2) -> bool:
    """Whether some run of words of the text, of any length, is within the edits."""
    words, wanted = ([re.sub(r"[^a-z0-9\x80-\U0010ffff]", " ", x.lower()).split() for x in (text or "", item)])
    n = len(wanted)
    if not n:
        return False
    row = [0] * (len(words) + 1)
    for i, x in enumerate(wanted, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row) <= int(share * n)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    syllables = ["ka", "lo", "mi", "tu", "re", "san", "vel", "dor", "pi", "ne", "qua", "zim"]
    made = ["".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(words)]
    return " ".join(w + ("\n" if draw.random() < 0.06 else "") for w in made)


def moved(text: str, seed: int, edits: int, kinds: str = "sdi") -> str:
    """Words substituted, dropped and put in at different places."""
    draw, words = random.Random(seed), text.split()
    for at in sorted(draw.sample(range(1, len(words) - 1), edits), reverse=True):
        kind, new = draw.choice(kinds), f"w{draw.randrange(10**6)}"
        words[at : at + 1] = {"s": [new], "d": [], "i": [words[at], new]}[kind]
    return " ".join(words)


def edited(text: str, seed: int, edits: int) -> str:
    draw, words = random.Random(seed), text.split(" ")
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)
