"""Plain versions of the operators, for comparison on small data."""

import math
import re
from collections import Counter, defaultdict

import xxhash

ODD_TEXTS = [None, "", " ", "\n\n", "a", "Tab\tand\x0bvt", "1234567890", "é ü ß — 漢字 😀", "word " * 3000, "x" * 5000]


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text, shingle=4):
    found = words(lower(text))
    if not found:
        return 0
    parts = [found] if len(found) < shingle else [found[i : i + shingle] for i in range(len(found) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, links):
    """Smallest node reachable from each."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def near_duplicates(docs, max_bits=4):
    """Component of each (id, text)."""
    prints = {i: fingerprint(t) for i, t in docs}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= max_bits]
    return prints, components(ids, links)


def masked(line):
    found = [w for w in re.split("[\x20\x09-\x0d]+", line) if w]
    return tuple("<*>" if re.search("[0-9]", w) else w for w in found)


def dropped_lines(docs, depth=4, least=4, similarity=0.8, key=None):
    """(id, line number) of the lines that go, by the definition of the template tree.

    ``key`` numbers the lines of a leaf; ties between equally frequent lines depend on it.
    """
    places = defaultdict(list)
    for i, text in docs:
        for at, line in enumerate((text or "").split("\n")):
            tokens = masked(line)
            if len(tokens) >= least:
                places[tokens].append((i, at))
    leaves = defaultdict(list)
    for tokens in places:
        leaves[(len(tokens), tokens[:depth])].append(tokens)
    links = []
    for members in leaves.values():
        n, tail = len(members[0]), max(0, len(members[0]) - depth)
        allowed = math.floor((1 - similarity) * n + 1e-9)
        if not tail:
            continue
        for s in range(allowed + 1):
            a, b = (depth + s * tail // (allowed + 1), depth + (s + 1) * tail // (allowed + 1))
            groups = defaultdict(list)
            for tokens in members:
                groups[tokens[a:b]].append(tokens)
            for group in groups.values():
                top = max(group, key=lambda t: (len(places[t]), key(t)))
                for tokens in group:
                    if sum(x != y for x, y in zip(tokens, top)) <= allowed:
                        links.append((tokens, top))
    group = components(list(places), links)
    members = defaultdict(list)
    for tokens, g in group.items():
        members[g] += places[tokens]
    return {(i, at) for found in members.values() for i, at in found if i > min(found)[0]}


def best_cut(word, pieces, unknown):
    """Tokens of the best cut of a word into pieces, by recursion over all cuts."""
    best = {0: (0.0, 0)}
    for end in range(1, len(word) + 1):
        options = [
            (best[start][0] + pieces[word[start:end]], -(best[start][1] + 1)) for start in range(end) if word[start:end] in pieces
        ]
        if word[end - 1] not in pieces:
            options.append((best[end - 1][0] + unknown, -(best[end - 1][1] + len(word[end - 1].encode()))))
        top = max(options)
        best[end] = (top[0], -top[1])
    return best[len(word)][1]


def unigram_base(docs, trains):
    """n_tokens, n_known and base score of each text under the unigram of the training texts."""
    counts = Counter(w for i, t in docs if trains(i) for w in words(lower(t)))
    ends = sum(trains(i) for i, _ in docs)
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = {}
    for i, t in docs:
        found = words(lower(t))
        c = [counts[w] for w in found] + [ends]
        out[i] = (len(c), sum(x > 0 for x in c), n, sum(math.log10((x + 1) / (n + v + 1)) for x in c))
    return out
