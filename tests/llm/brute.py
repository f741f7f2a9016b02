"""Plain versions of the operators for small inputs."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size):
    words = WORD.findall(folded(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) or frozenset([tuple(words)])


def components(rows, size, percent):
    """Per row: (set size, smallest id reachable); null ids are last."""
    sets = [shingles(text, size) for _, text in rows]
    label = [float("inf") if i is None else i for i, _ in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return [(len(s), None if x == float("inf") else x) for s, x in zip(sets, label)]


def removed(rows, width):
    """Per row: (bytes, removed flags)."""
    low = {}
    data = [(float("inf") if i is None else i, (text or "").encode()) for i, text in rows]
    for i, text in data:
        for p in range(len(text) - width + 1):
            key = text[p:p + width]
            low[key] = min(low.get(key, i), i)
    out = []
    for i, text in data:
        gone = [False] * len(text)
        reach = 0
        for p in range(len(text)):
            if p + width <= len(text) and low[text[p:p + width]] < i:
                reach = p + width
            gone[p] = p < reach
        out.append((text, gone))
    return out


def measures(text):
    words = WORD.findall(text or "")
    runs = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if runs[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, doubled = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            doubled += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), doubled, len(covered)


def targets(sizes, share, weights):
    """Source (None last) to target, by reshared excess."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    cap = {s: 2.0 * sizes[s] for s in order}
    free, out, due = set(order), {}, share * sum(sizes.values())
    while free:
        level = (due - sum(cap[s] for s in out)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= cap[s]}
        if not over:
            break
        out |= {s: cap[s] for s in over}
        free -= over
    return out | {s: level * weight[s] for s in free}


def by_id(rows):
    found = defaultdict(list)
    for key, *rest in rows:
        found[key].append(tuple(rest))
    return {k: sorted(v, key=repr) for k, v in found.items()}
