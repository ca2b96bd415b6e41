"""Plain Python versions of the digest queries."""

import hashlib
import math
import re
from collections import Counter

import regex

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tokens(text):
    return TOKEN.findall((text or "").translate(LOWER))


def base_rules(text):
    text = text or ""
    words = BLANK_WORD.findall(text)
    lines = [x for x in text.split("\n") if BLANK_WORD.search(x)]
    seen, again = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            again |= {p + k for p in places for k in range(8)}
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed


def licenses(text):
    words, hits = tokens(text), []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        hits += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def license_spans(words, templates, labels, anchor=5, gap=40):
    """Chains of anchors by plain loops: longest matches, all pairs of anchors, all pairs of candidates."""

    def longest(end):  # of the match that ends before ``end``
        return max((n for t in templates for p in range(1, len(t) + 1) for n in [tail(t, p, end)]), default=0)

    def tail(t, p, end):
        n = 0
        while n < min(p, end) and t[p - 1 - n] == words[end - 1 - n]:
            n += 1
        return n

    best = [0] + [longest(k) for k in range(1, len(words) + 1)] + [0]
    ends = [k for k in range(1, len(words) + 1) if best[k] >= anchor and best[k + 1] <= best[k]]
    out = []
    for t, label in zip(templates, labels):
        found = sorted((k - best[k], p - best[k], best[k]) for k in ends for p in range(1, len(t) + 1) if tail(t, p, k) == best[k])
        cover, first = [n for *_, n in found], list(range(len(found)))
        for i, (s, p, n) in enumerate(found):
            for j, (s2, p2, n2) in enumerate(found[:i]):
                add = n - max(0, s2 + n2 - s, p2 + n2 - p)
                if s2 < s and p2 < p and s2 + n2 + gap >= s and s2 >= s - gap - len(t) and add > 0 and cover[j] + add > cover[i]:
                    cover[i], first[i] = cover[j] + add, first[j]
            if cover[i] >= (0.6 if len(t) >= 30 else 0.9) * len(t):
                begin, end, c = found[first[i]][0], s + n, min(cover[i], len(t))
                out.append((-(2 * c - len(t) - max(0, end - begin - c)), -c / len(t), label, begin, end))
    kept = []
    for _, c, label, begin, end in sorted(out):
        if all(end <= b or begin >= e for b, e, *_ in kept):
            kept.append((begin, end, label, round(-c, 9)))
    return sorted(kept)


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def pii(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    kinds = ("email", "ip", "card", "phone")
    written = [f"{kinds[r]}:{s}:{e}" for s, r, e in sorted(out)]
    return [sum(r == k for _, r, _ in out) for k in range(4)], sha(",".join(written)), written


_NAME = r"(?:token|secret|passw(?:or)?d|api[_-]?key|key)[\x22']?[\x20\t]{0,3}[=:][\x20\t]{0,3}[\x22']?"
GENERATORS = (
    r"[+(]?[0-9][\x20().0-9-]{5,}[0-9]",
    r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}+",
    rf"(?i)(?<={_NAME})[^\x00-\x20\x22',;]{{4,}}+",
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9:.])(?:[0-9A-Fa-f]{0,4}:){2,7}+[0-9A-Fa-f]{0,4}+(?![A-Za-z0-9:])",
)


def pii_candidates(text):
    """(generator, start, end, named, features but the first) of each candidate."""
    text, out = text or "", []
    octet = lambda x: x.isascii() and x.isdigit() and int(x) <= 255
    bucket = lambda n, *edges: sum(n >= e for e in edges)
    for gen, pattern in enumerate(GENERATORS):
        for m in regex.finditer(pattern, text):
            x, s, e = m[0], m.start(), m.end()
            digits = re.sub("[^0-9]", "", x)
            if gen == 1 and not digits:
                continue
            check = 12 <= len(digits) <= 19 and luhn(digits)
            form = len(x.split(".")) == 4 and all(map(octet, x.split(".")))
            if gen == 3:
                flat = x.replace(" ", "")
                check = int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1
            if gen == 4:
                groups = x.split(":")
                form = len(groups) == 8 and all(groups) if "::" not in x else x.count("::") == 1 and ":::" not in x and x.count(":") >= 3 and not (x[0] == ":" != x[1] or x[-1] == ":" != x[-2]) and all(len([g for g in side.split(":") if g]) <= 6 for side in x.split("::"))
            quotes = (text[s - 1 : s] in ("'", '"') and s > 0) + (text[e : e + 1] in ("'", '"') and e < len(text))
            features = (
                bucket(len(x), 9, 12, 16, 20, 32, 41), bucket(len(digits), 1, 7, 9, 12, 16, 20), bool(re.search("[A-Za-z]", x)), bool(re.fullmatch("[0-9a-fA-F]+", x)),
                bucket(len(re.sub(r"[^\x20().-]", "", x)), 1, 3, 5), {"+": 2, "(": 1}.get(x[0], 0), check, form, quotes, bool(re.search(r"[0-9]{3,}[\x20.-][0-9]{3,}", x)),
            )
            out.append((gen, s, e, bool(regex.search(f"(?i){_NAME}$", text[max(0, s - 20) : s])), *map(int, features)))
    return out


def language_model(labelled, longest, prior):
    """A function from a text to (language, score), from (language, text) by plain counting."""
    letters = regex.compile(r"\p{L}+")
    langs = sorted({x for x, _ in labelled})
    counts = [Counter() for _ in range(longest + 1)]
    grams = lambda w, n: [w[i : i + n] for w in ([f"^{w}$"] if n > 1 else [w]) for i in range(len(w) - n + 1)]
    for lang, text in labelled:
        for word, times in Counter(letters.findall(text.lower())).items():
            counts[0][word, lang] += times
            for n in range(1, longest + 1):
                for g in grams(word, n):
                    counts[n][g, lang] += times
    totals = [{x: sum(c for (_, lang), c in table.items() if lang == x) for x in langs} for table in counts]
    named = [{item for item, _ in table} for table in counts]

    def logs(n, item):
        mean = sum(counts[n][item, x] / totals[n][x] for x in langs) / len(langs)
        return [math.log((counts[n][item, x] + prior * mean) / (totals[n][x] + prior) / mean) for x in langs]

    seen = {}

    def word_logs(word):
        if word not in seen:
            seen[word] = None
            for n, items in [(0, [word])] + [(n, grams(word, n)) for n in range(longest, 0, -1)]:
                hits = [logs(n, g) for g in items if g in named[n]]
                if hits:
                    seen[word] = [sum(x) / len(hits) for x in zip(*hits)]
                    break
        return seen[word]

    def predict(text):
        words = letters.findall((text or "").lower()) if text and any(map(str.isalpha, text)) else []
        found = [x for w in words if (x := word_logs(w))]
        if not found:
            return "und", 0.0
        total = [sum(x) for x in zip(*found)]
        best = max(total)
        odds = sum(math.exp((t - best) / len(words) * min(len(words), 30)) for t in total)
        return langs[total.index(best)], 1 / odds

    return predict


def benchmark_hits(text, items):
    words, hit, found = tokens(text), set(), set()
    for item, item_text in items:
        w = tokens(item_text)
        size = min(10, len(w))
        grams = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def shingle_set(text):
    w = TOKEN.findall((text or "").lower())
    size = min(5, len(w))
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if w else frozenset()


def similarity_classes(docs):
    """(doc_id, class_id, copy_of, links) of each row by comparing all pairs; ids
    may repeat or be missing, and classes are of texts."""
    sets = [shingle_set(t) for _, t in docs]
    names = {}
    for (d, _), s in zip(docs, sets):
        names.setdefault(s, []).append(d)
    least = lambda ids: min((d for d in ids if d is not None), default=None)
    reps = [s for s in names if s]
    holders = {}
    for r in reps:
        for g in r:
            holders.setdefault(g, []).append(r)
    links = {r: set() for r in reps}
    for r in reps:
        common = {}
        for g in r:
            for o in holders[g]:
                common[o] = common.get(o, 0) + 1
        for o, c in common.items():
            if o != r and c >= 0.8 * (len(r) + len(o) - c) - 1e-9:
                links[r].add(o)
    of = {}
    for r in reps:
        if r in of:
            continue
        todo, members = [r], {r}
        while todo:
            for o in links[todo.pop()] - members:
                members.add(o)
                todo.append(o)
        of |= dict.fromkeys(members, least([d for m in members for d in names[m]]))
    return [(d, of[s], least(names[s]), len(links[s])) if s else (d, d, d, 0) for (d, _), s in zip(docs, sets)]
