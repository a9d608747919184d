"""Near-duplicate groups by comparing all pairs (helper of the tests)."""

SPACE = "\t\n\x0b\x0c\r "


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out, own = [], ""
    for c in low + " ":
        if c in SPACE:
            if own:
                out.append(own)
            own = ""
        else:
            own += c
    return out


def _set(text, width):
    w = _words(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute(rows, width, percent):
    sets = [_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted((repr(d), len(s), least.get(top(i)) if d is not None else None, d is None or least[top(i)] == d)
                  for i, ((d, _), s) in enumerate(zip(rows, sets)))
