"""Small brute-force versions that the tests hold the operators against."""

import re

SHINGLE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, width=4):
    words = SHINGLE_WORD.findall(lower(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def components(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, by all pairs that share a shingle."""
    sets, parent, holders = [shingle_set(t) for _, t in rows], list(range(len(rows))), {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        shared = {}
        for g in own:
            for j in holders.setdefault(g, []):
                shared[j] = shared.get(j, 0) + 1
            holders[g].append(i)
        for j, n in shared.items():
            if 100 * n >= 85 * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((doc, len(sets[i]), least[root(i)] if sets[i] else doc) for i, (doc, _) in enumerate(rows))


def hits(text, items, window=10):
    """(words, hit words, sorted ids) of a document against (id, text) items."""
    words, hit, ids = ALNUM_WORD.findall(lower(text)), set(), set()
    for name, item in items:
        own = ALNUM_WORD.findall(lower(item))
        n = min(window, len(own))
        for s in range(len(own) - n + 1 if n else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == own[s : s + n]:
                    hit.update(range(p, p + n))
                    ids.add(str(name))
    return len(words), len(hit), sorted(ids)


def base_spans(text):
    order = ("email", "ip", "card", "phone")
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c in "0123456789"]
        if 14 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], order.index(s[0])))


def targets(sizes, weights=(1, 2, 3), most=3):
    """Targets of {source: size} by repeated sharing."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = float(most * sizes[s])
        open_ -= over
    return out
