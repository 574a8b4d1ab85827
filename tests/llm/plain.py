"""Plain versions of the operators, written from their contracts."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    found = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def shingles(text, n):
    found = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(found[k : k + n]) for k in range(max(1, len(found) - n + 1))) if found else frozenset()


def linked(rows, n, least):
    """doc_id -> (set size, smallest linked doc_id, links), for distinct doc_ids."""
    sets = {i: shingles(t, n) for i, t in rows}
    head, degree, holders = {i: i for i in sets}, Counter(), defaultdict(list)

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, own in sets.items():
        shared = Counter(j for g in own for j in holders[g])
        for g in own:
            holders[g].append(i)
        for j, k in shared.items():
            if 100 * k >= least * (len(own) + len(sets[j]) - k):
                degree[i] += 1
                degree[j] += 1
                a, b = find(i), find(j)
                head[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), degree[i]) for i, s in sets.items()}


def article(page):
    """Main text of the given pages, whose article holds h1, p, b and br alone."""
    found = re.search(r"<article>(.*?)</article>", page, re.S)
    inner = re.sub(r"</?(?:b|br)>", " ", found[1])
    blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def top_k(vectors, k, every):
    out = []
    for q, v in vectors:
        if q % every == 0:
            scores = sorted((-sum(int(a) * int(b) for a, b in zip(v, w, strict=True)), x) for x, w in vectors if x != q)
            out += [(q, r + 1, x, -s) for r, (s, x) in enumerate(scores[:k])]
    return sorted(out)
