"""Plain versions of the operators, for a handful of documents."""

from collections import defaultdict

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return (text or "").encode().split()


def shingles(text, size):
    w = [x.lower() for x in words(text)]
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def groups(ids, linked):
    """The smallest id reachable from each, and each one's number of links."""
    low, links = {i: i for i in ids}, defaultdict(int)

    def top(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in linked:
        links[a] += 1
        links[b] += 1
        a, b = top(a), top(b)
        low[max(a, b)] = min(a, b)
    return {i: (top(i), links[i]) for i in ids}


def jaccard(texts, size, num, den):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    ids = sorted(sets)
    pairs = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), *found) for i, found in groups(ids, pairs).items()}


def line_runs(texts, min_words):
    """The texts without lines of any run with enough words that came up earlier."""
    seqs = {d: [(i, x) for i, x in enumerate(t.split("\n")) if words(x)] for d, t in sorted(texts.items())}
    first = {}
    for d, seq in seqs.items():
        for a in range(len(seq)):
            for b in range(a + 1, len(seq) + 1):
                first.setdefault(tuple(x for _, x in seq[a:b]), (d, a))
    out = {}
    for d, seq in seqs.items():
        gone = set()
        for a in range(len(seq)):
            for b in range(a + 1, len(seq) + 1):
                run = [x for _, x in seq[a:b]]
                if sum(len(words(x)) for x in run) >= min_words and first[tuple(run)] != (d, a):
                    gone |= {i for i, _ in seq[a:b]}
        out[d] = "\n".join(x for i, x in enumerate(texts[d].split("\n")) if i not in gone), len(gone)
    return out


def measures(text):
    w = words(text)
    runs = defaultdict(list)
    for i in range(len(w) - 4):
        runs[tuple(w[i : i + 5])].append(i)
    covered = {i + k for at in runs.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(len(x.decode()) for x in w),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }
