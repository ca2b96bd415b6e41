"""Licence scans: a generalised suffix automaton of licence tokens.

The automaton holds all templates and the base phrases.  A text is streamed
through it to get matching statistics (for each token, the longest match that
ends there and where it stands in the templates).  Matches that cannot be
extended are anchors; anchors of one template that follow each other in both
text and template are chained, and a chain that covers enough of the template
is a candidate.  Licences share most of their words with their kin, so of
candidates that overlap only the closest stands: that whose covered tokens,
less the template's uncovered ones and the text's foreign ones inside the
chain, are most.  A short template, which a word or two can turn into another
licence, must be covered nearly whole.

The automaton is of fixed size and goes with the function.  Texts go through
Python in Arrow batches, one row out for one row in: no shuffle, no state
between rows, and a lost executor costs its batches only.  Tokens outside the
templates' words end a match, so only runs of known tokens are streamed.

Defined cases: a null or empty text has no words and score 0; labels are
distinct and sorted; a template covered twice is one label with two spans; of
equally close candidates the better covered, then the first by label stands;
rows that repeat each get a row; columns of any other name play no part.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_texts import PHRASES, TEMPLATES

#: Shortest anchor, in tokens, and least cover of a template, and of one of
#: less than SHORT tokens.
ANCHOR = 5
COVER = 0.6
SHORT, SHORT_COVER = 30, 0.9
#: Most tokens between anchors of a chain, in the text.
GAP = 40

_TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text: str | None) -> list[str]:
    if not text:
        return []
    return _TOKEN.findall(text.lower() if text.isascii() else text.translate(_LOWER))


class Automaton:
    """Suffix automaton over token numbers of several token lists."""

    def __init__(self, lists: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for which, numbers in enumerate(lists):
            last = 0
            for place, number in enumerate(numbers):
                last = self._extend(last, number, ends)
                ends[last].add((which, place))
        # A state occurs wherever the states below it in the link tree do.
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            ends[self.link[state]] |= ends[state]
        ends[0] = set()
        self.ends = [sorted(x) for x in ends]

    def _add(self, size: int, ends: list) -> int:
        self.next.append({})
        self.link.append(0)
        self.size.append(size)
        ends.append(set())
        return len(self.size) - 1

    def _split(self, p: int, number: int, q: int, ends: list) -> int:
        twin = self._add(self.size[p] + 1, ends)
        self.next[twin] = dict(self.next[q])
        self.link[twin], self.link[q] = self.link[q], twin
        while p >= 0 and self.next[p].get(number) == q:
            self.next[p][number] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, number: int, ends: list) -> int:
        q = self.next[last].get(number)
        if q is not None:  # an earlier list has this
            return q if self.size[q] == self.size[last] + 1 else self._split(last, number, q, ends)
        new, p = self._add(self.size[last] + 1, ends), last
        while p >= 0 and number not in self.next[p]:
            self.next[p][number] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][number]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, number, q, ends)
        return new


class Scanner:
    """Templates, phrases and their automaton."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.labels = [label for label, _ in templates] + [label for _, label in phrases]
        lists = [tokens(text) for _, text in templates] + [tokens(text) for text, _ in phrases]
        self.n_templates, self.lengths = len(templates), [len(x) for x in lists]
        self.numbers = {w: k for k, w in enumerate(sorted({w for x in lists for w in x}))}
        self.automaton = Automaton([[self.numbers[w] for w in x] for x in lists])
        # The phrases that end with each state, found at the whole phrase.
        whole = {}
        for which in range(self.n_templates, len(lists)):
            state = 0
            for w in lists[which]:
                state = self.automaton.next[state][self.numbers[w]]
            whole.setdefault(state, []).append((self.lengths[which], self.labels[which]))
        self.phrases: list[tuple] = [()] * len(self.automaton.size)
        for state in sorted(range(1, len(self.automaton.size)), key=self.automaton.size.__getitem__):
            self.phrases[state] = (*self.phrases[self.automaton.link[state]], *whole.get(state, ()))
        self.least = min([ANCHOR, *self.lengths[self.n_templates :]])
        self.last_words = {self.numbers[lists[k][-1]] for k in range(self.n_templates, len(lists))}

    def statistics(self, numbers: list[int]) -> Iterator[tuple[int, int, int]]:
        """(place, length, state) of the longest match that ends at a token."""
        step, link, size = self.automaton.next, self.automaton.link, self.automaton.size
        state = length = 0
        for place, number in enumerate(numbers):
            found = step[state].get(number)
            while found is None and state:
                state = link[state]
                length = size[state]
                found = step[state].get(number)
            if found is None:
                length = 0
            else:
                state, length = found, length + 1
            yield place, length, state

    def scan(self, words: list[str]) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, float]]]:
        """Phrase starts with labels, and (start, end, label, cover) spans."""
        get, phrases, anchors = self.numbers.get, [], []
        begin, n = 0, len(words)
        numbers = [get(w, -1) for w in words]
        while begin < n:
            if numbers[begin] < 0:
                begin += 1
                continue
            end = begin
            while end < n and numbers[end] >= 0:
                end += 1
            run = numbers[begin:end]
            if len(run) >= ANCHOR or (len(run) >= self.least and not self.last_words.isdisjoint(run)):
                before = None
                for place, length, state in self.statistics(run):
                    for size, label in self.phrases[state]:
                        if size <= length:
                            phrases.append((begin + place - size + 1, label))
                    if before and length <= before[1] and before[1] >= ANCHOR:
                        anchors.append((begin + before[0] + 1 - before[1], before[1], before[2]))
                    before = (place, length, state)
                if before and before[1] >= ANCHOR:
                    anchors.append((begin + before[0] + 1 - before[1], before[1], before[2]))
            begin = end
        return phrases, self.chains(anchors)

    def chains(self, anchors: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float]]:
        """Cover of templates by anchors (start, length, state) in order."""
        per: dict[int, list[tuple[int, int, int]]] = {}
        for start, length, state in anchors:
            for which, end in self.automaton.ends[state]:
                if which < self.n_templates:
                    per.setdefault(which, []).append((start, end - length + 1, length))
        candidates = []
        for which, found in per.items():
            found.sort()
            total = self.lengths[which]
            starts = [x[0] for x in found]
            covers = [x[2] for x in found]
            froms = list(range(len(found)))
            for i, (start, place, length) in enumerate(found):
                # Anchors that can precede begin at most a gap and a template back.
                for j in range(bisect_left(starts, start - GAP - total), i):
                    s, p, size = found[j]
                    if s + size + GAP < start or p >= place or s >= start:
                        continue
                    gain = length - max(0, s + size - start, p + size - place)
                    if gain > 0 and covers[j] + gain > covers[i]:
                        covers[i], froms[i] = covers[j] + gain, froms[j]
            for i, (start, _, length) in enumerate(found):
                if covers[i] >= (COVER if total >= SHORT else SHORT_COVER) * total:
                    begin, end = found[froms[i]][0], start + length
                    covered = min(covers[i], total)
                    closeness = covered - (total - covered) - max(0, end - begin - covered)
                    candidates.append((-closeness, -covered / total, self.labels[which], begin, end))
        # The closest first; spans that stand do not overlap, so a new one can only meet its neighbours.
        begins, spans = [], []
        for _, cover, label, begin, end in sorted(candidates):
            k = bisect_left(begins, begin)
            if (k and spans[k - 1][1] > begin) or (k < len(spans) and spans[k][0] < end):
                continue
            begins.insert(k, begin)
            spans.insert(k, (begin, end, label, -cover))
        return spans


SCHEMA = "n_words long, phrases array<struct<start:long,label:string>>, spans array<struct<start:long,end:long,label:string,cover:double>>"


def scan(docs: DataFrame, *keep: str, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``keep`` columns with n_words, phrases and spans (places in words)."""

    @F.pandas_udf(SCHEMA)
    def scanned(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates, phrases)
        for batch in texts:
            rows = []
            for text in batch:
                words = tokens(text)
                found, spans = scanner.scan(words)
                rows.append((len(words), [{"start": s, "label": x} for s, x in found], [dict(zip(("start", "end", "label", "cover"), x, strict=True)) for x in spans]))
            yield pd.DataFrame(rows, columns=["n_words", "phrases", "spans"])

    return docs.select(*keep, scanned("text").alias("_s")).select(*keep, "_s.*")


def report(found: DataFrame) -> DataFrame:
    base = F.array_sort(F.array_distinct(F.transform("phrases", lambda x: x["label"])))
    every = F.array_sort(F.array_distinct(F.concat(F.transform("phrases", lambda x: x["label"]), F.transform("spans", lambda x: x["label"]))))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(F.transform("phrases", lambda x: x["start"])).alias("first_word"),
        F.array_max(F.transform("phrases", lambda x: x["start"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda x: x["cover"])), F.lit(0.0))).alias("score"),
    )
