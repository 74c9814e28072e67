"""Plain versions of the operators, word by word, and small messy tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, `_row` string, items string, epochs string, `a.b` int"


def lower(x: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), x)


def words(x: str | None, pattern: str = SPACE_WORD, low: bool = False) -> list[str]:
    return re.findall(pattern, lower(x or "") if low else x or "")


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    """Words from a fixed rule, with a new line now and then."""
    out, x = [], seed * 7919 + 17
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"w{(x >> 8) % vocabulary}" + ("\n" if i % 23 == 22 else ""))
    return out


def messy(passage: str) -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty and very long texts, repeated rows, clashing names."""
    base = prose(1, 120)
    near = [*base[:60], "other", *base[61:]]
    texts = [
        " ".join(base), " ".join(base), " ".join(near), "  ".join(base) + "\t", None, "", " \n\t ", "one two three", "One two three",
        " ".join(prose(2, 70)) + " " + passage + " " + " ".join(prose(3, 40)), passage, " ".join(passage.split()[3:]),
        " ".join(prose(4, 30_000, 5000)), "x" * 200_000, "Ünïcode wörds ωμέγα 漢字 " * 20, "\x0b\x0cform feed\x0b", " ".join(prose(5, 90)) + " " + passage.upper(),
        "tie tie tie tie tie tie tie tie tie tie tie tie " * 6, " ".join(base[:100]), " ".join([*base, *prose(6, 5)]),
    ]
    rows = [(i, t, "en" if i % 3 else None, None if i % 5 == 0 else f"src{i % 4}") for i, t in enumerate(texts)]
    rows += [rows[0], rows[9], (None, " ".join(base), "en", "src1"), (None, None, None, None), (None, passage, None, "src2")]
    return [(*r, len(r[1]) if r[1] else None, "n", "r", "i", "e", 7) for r in rows]


def decontamination(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    windows = defaultdict(set)
    for item, text in items:
        w = words(text, ALNUM_WORD, True)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add("null" if item is None else str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w = words(text, ALNUM_WORD, True)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[k]
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def substrings(docs: list[tuple]) -> list[tuple]:
    first: dict[tuple, float] = {}
    at = lambda d: math.inf if d is None else d
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(first.get(k, math.inf), at(doc))
    out = []
    for doc, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < at(doc):
                gone |= set(range(i, i + 50))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def near_duplicates(docs: list[tuple], n: int) -> list[tuple]:
    sets = []
    for _, text in docs:
        w = words(text, low=True)
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    parent = list(range(len(docs)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least: dict[int, int | None] = {}
    for i, (doc, _) in enumerate(docs):
        r = root(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    out = []
    for i, (doc, _) in enumerate(docs):
        component = least[root(i)] if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return out


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def personal(text: str | None) -> list[tuple[int, int, str]]:
    text = text or ""
    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    return [(a, b, k) for a, _, b, k in sorted(out)]


def rules(text: str | None) -> tuple:
    text = text or ""
    w = words(text)
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    counts = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {p for i in range(len(w) - 7) if counts[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def kneser_ney(docs: list[tuple], order: int, discounts) -> list[tuple]:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) by dictionaries."""
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs]
    tokens = [[*words(t, low=True), "</s>"] for _, t in docs]
    count: dict[int, Counter] = {order: Counter()}
    single: Counter = Counter()
    for s, h in zip(tokens, held, strict=True):
        if not h:
            single.update(s)
            p = ["<s>"] * (order - 1) + s
            count[order].update(tuple(p[i : i + order]) for i in range(len(s)))
    for n in range(order - 1, 0, -1):
        count[n] = Counter()
        for g, c in count[n + 1].items():
            count[n][g[1:]] += c if n > 1 and g[1] == "<s>" else 1
    total, size = sum(single.values()), len(single)
    d = {n: discounts([sum(x == i for x in count[n].values()) for i in (1, 2, 3, 4)]) for n in count}
    stats: dict = {n: defaultdict(lambda: [0, 0, 0, 0]) for n in count}
    for n in count:
        for g, c in count[n].items():
            stats[n][g[:-1]][0] += c
            stats[n][g[:-1]][min(c, 3)] += 1

    def p(g: tuple) -> float:
        n = len(g)
        low = p(g[1:]) if n > 1 else 1 / (size + 1)
        s = stats[n].get(g[:-1])
        if not s:
            return low
        c = count[n].get(g, 0)
        return max(c - d[n][min(c, 3)], 0) / s[0] + sum(s[k] * d[n][k] for k in (1, 2, 3)) / s[0] * low

    out = []
    for (doc, _), h, s in zip(docs, held, tokens, strict=True):
        padded = ["<s>"] * (order - 1) + s
        out.append(
            (doc, h, len(s), sum(w in single for w in s), total, sum(math.log10((single[w] + 1) / (total + size + 1)) for w in s),
             sum(math.log10(p(tuple(padded[i : i + order]))) for i in range(len(s))))
        )
    return out
