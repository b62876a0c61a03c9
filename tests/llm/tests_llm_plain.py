"""Plain versions that more than one test needs."""

import re

import xxhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=3):
    """Least member of the component, for each of the different fingerprints."""
    prints = sorted(set(prints))
    parent = {f: f for f in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in prints}


def brute_contaminated(text, passage, n=10):
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower())
    words, item = cut(text), cut(passage)
    windows = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)}
    return any(tuple(words[k : k + n]) in windows for k in range(len(words) - n + 1))
