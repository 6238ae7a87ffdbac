"""Plain-Python versions of the corpus operators, for small fixtures. Rows are (doc_id, text, lang, source)."""

import math
import re
import struct

import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = b" \t\n\x0b\x0c\r"


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def hash_of(*values):
    """Spark's xxhash64 of longs and strings, nulls skipped; unsigned."""
    seed = 42
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", v) if isinstance(v, int) else v.encode(), seed)
    return seed


def id_key(row):
    return (row[0] is None, row[0] or 0, signed(hash_of(row[1] or "")))


# quality rules


def counts(text):
    w = WORDS.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = {}
    for g in grams:
        times[g] = times.get(g, 0) + 1
    repeat = len({i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)})
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, len(lines)


def kept_by_rules(rows, features, fence, shrink, base=True):
    """One boolean a row. features: name -> (least spread, side), as the module documents them. Without `base` the base
    rules only choose the documents to learn from."""
    own, verdict = {}, []
    for _, text, lang, source in rows:
        t = text or ""
        n, chars, symbols, dups, repeat, lines = counts(t)
        value = {
            "mean_word": chars / max(n, 1), "symbols": symbols / max(n, 1), "dup_lines": dups / max(lines, 1), "repeats": repeat / max(n, 1),
            "capitals": len(re.findall("[A-Z]", t)) / max(chars, 1), "shouts": t.count("!") / max(n, 1),
        }
        failed = n < 50 or 100 * repeat > 50 * n
        verdict.append((failed if base else n == 0, value, (lang, source), math.sqrt(max(1, 50 / max(n, 1)))))
        own.setdefault((lang, source), [])
        if not failed:
            own[lang, source].append(value)
    binned = lambda x: 2 ** (math.floor(math.log2(x) * 64 + 0.5) / 64) if x > 0 else 0.0
    at = lambda v, p: binned(sorted(v)[max(math.ceil(p * len(v)) - 1, 0)]) if v else None
    mean = lambda pairs: sum(w * v for w, v in pairs if w > 0) / sum(w for w, _ in pairs if w > 0) if any(w > 0 for w, _ in pairs) else None

    def drawn(n, value, toward_n, toward):
        return (n * value + toward_n * toward) / (n + toward_n) if n > 0 else toward

    limits = {}
    for f in features:
        for p in (0.25, 0.75):
            by_lang = {}
            for (lang, _), vs in own.items():
                by_lang.setdefault(lang, []).append((len(vs) / (len(vs) + shrink), at([v[f] for v in vs], p)))
            of_lang = {k: (sum(w for w, _ in x), mean(x)) for k, x in by_lang.items()}
            overall = mean([(w / (w + 1), v) for w, v in of_lang.values()])
            for (lang, source), vs in own.items():
                w, v = of_lang[lang]
                limits[lang, source, f, p] = drawn(len(vs), at([x[f] for x in vs], p), shrink, drawn(w, v, 1, overall))
    out = []
    for failed, value, group, room in verdict:
        fits = True
        for f, (least, side) in features.items():
            low, high = limits[*group, f, 0.25], limits[*group, f, 0.75]
            if low is None:
                continue
            spread = max(high - low, least) * fence * room
            fits &= value[f] <= high + spread and (side == "above" or value[f] >= low - spread)
        out.append(not failed and fits)
    return out


# near copies


def one_of_each(rows):
    """The rows that stay: of texts linked by Jaccard 0.8 or more of distinct five-word shingles, the least doc_id."""
    sets = []
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        sets.append(frozenset(b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if (k := top(i)) not in least or id_key(r) < id_key(least[k]):
            least[k] = r
    return list(least.values())


# secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = (("assign", ASSIGN, 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16), ("live", re.compile("(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]+"), 0, 24))


def secret_spans(rows):
    """(doc_id, text) -> spans (start, kind, end, secret's start, live) that stay."""
    found, owners, repos = {}, {}, {}
    for d, t, _, s in rows:
        t = t or ""
        for k, (_, pattern, group, least) in enumerate(KINDS):
            for m in pattern.finditer(t):
                v = m[group]
                if len(v) < least or k == 3 and not (re.search("[A-Z]", v) and re.search("[a-z]", v) and re.search("[0-9]", v)):
                    continue
                found.setdefault((d, t), set()).add((m.start(), k, m.end(), v))
                owners.setdefault(v, set()).add(s)
                repos.setdefault(v, set()).add(t)
    out = {}
    for key, spans in found.items():
        rated = [(a, k, b, b - len(v), not (len(owners[v]) > 2 and len(repos[v]) > 2)) for a, k, b, v in sorted(spans)]
        base = [x for x in rated if x[1] < 3]
        out[key] = [x for x in rated if x[1] < 3 or x[4] and not any(b[0] < x[2] and x[0] < b[2] for b in base)]
    return out


def redacted(text, spans, mark="<SECRET>"):
    out, at = "", 0
    for a, b in sorted((x[3], x[2]) for x in spans):
        if b > at:
            out += text[at:a] + mark if a >= at else ""
            at = b
    return out + text[at:] if spans else text


# mixing


def targets(rows):
    """source -> (size, target), by sharing out again and again."""
    sums = {}
    for _, t, _, s in rows:
        sums[s] = sums.get(s, 0) + len(WORDS.findall(t or ""))
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, free, target = float(sum(sums.values())), set(names), {}
    while free:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > 3 * sums[s]]
        if not over:
            target |= {s: share * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * sums[s]
            left -= target[s]
            free.remove(s)
    return {s: (sums[s], target[s]) for s in names}


def mix_key(doc_id):
    return signed(hash_of("mix-1", doc_id))


def mixed(rows):
    """(row, size, source_size, target, taken, start) in the order of keys."""
    of, out = targets(rows), []
    for s, (total, target) in of.items():
        here = sorted((r for r in rows if r[3] == s), key=lambda r: (mix_key(r[0]), r[0] is not None, r[0] or 0, len(WORDS.findall(r[1] or ""))))
        budget = min(round(target), 3 * total)
        epochs, at = budget // max(total, 1), 0
        rest = budget - epochs * total
        for r in here:
            size = len(WORDS.findall(r[1] or ""))
            out.append((r, size, total, target, epochs * size + max(0, min(size, rest - at)), at))
            at += size
    return out


def mixed_rows(rows):
    """The rows of the mix, whole, one for each epoch that takes them."""
    out, by_source = [], {}
    for x in mixed(rows):
        by_source.setdefault(x[0][3], []).append(x)
    for found in by_source.values():
        total, target = found[0][2], found[0][3]
        epochs = min(round(target), 3 * total) // max(total, 1)
        cuts = [mix_key(r[0]) for r, size, _, _, taken, _ in found if taken > epochs * size and (taken - epochs * size) * 2 >= size]
        for r, *_ in found:
            out += [r] * (epochs + (1 if cuts and mix_key(r[0]) <= max(cuts) else 0))
    return out
