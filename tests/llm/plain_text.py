"""Plain versions of the text operators, for comparison on small tables."""

import re
from collections import Counter, defaultdict
from hashlib import sha256

KINDS = ("email", "ip", "card", "phone")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def repeated(units, size, rows):
    """Per row which units lie in a window that also starts earlier."""
    seen, out = set(), []
    for row in rows:
        items, gone = units(row), [False] * len(units(row))
        for at in range(len(items) - size + 1):
            window = items[at:at + size]
            if window in seen:
                gone[at:at + size] = [True] * size
            seen.add(window)
        out.append(gone)
    return out


def word_dedup(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    units = [tuple(WORD.findall(t or "")) for _, t in rows]
    gone = repeated(lambda k: units[k], 20, range(len(rows)))
    return Counter((i, len(u), sum(g), sha256(" ".join(
        w for w, x in zip(u, g) if not x).encode()).hexdigest())
        for (i, _), u, g in zip(rows, units, gone))


def byte_dedup(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    units = [(t or "").encode() for _, t in rows]
    gone = repeated(lambda k: units[k], 100, range(len(rows)))
    return Counter((i, len(u), sum(g), sum(x and not y for x, y in zip(g, [False, *g])),
                    sha256(bytes(b for b, x in zip(u, g) if not x)).hexdigest())
                   for (i, _), u, g in zip(rows, units, gone))


def shingles(text, width):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = tuple(WORD.findall(words))
    if len(words) < width:
        return {words} if words else set()
    return {words[k:k + width] for k in range(len(words) - width + 1)}


def components(rows, width=4, percent=85):
    sets = {i: shingles(t, width) for i, t in rows}
    holders, root = defaultdict(list), {i: i for i in sets}
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in sets.items():
        for other, n in Counter(o for s in own for o in holders[s] if o < i).items():
            if 100 * n >= percent * (len(own) + len(sets[other]) - n):
                a, b = sorted((find(i), find(other)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}
