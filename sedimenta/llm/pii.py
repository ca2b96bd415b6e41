"""Personal data: candidates, boosted trees and calibrated thresholds, native.

Strict patterns with validators find the base kinds (email, ip, card, phone);
these spans always stand.  Broad generators propose more spans, which may
overlap those and each other: numbers, long tokens, whatever a name such as
``password`` is given, account numbers and colon-separated addresses.  Boosted
trees score a candidate by its format and context.  They learn from all
candidates.  A number or token is positive if it holds a valid base span or if
the text assigns it by name (the name itself is not a feature, so that the
format speaks for tokens that nothing names); a named value if it is quoted or
has a digit; an account number by its check digits; an address by its form.
The trees are fitted on half of the documents; the threshold of each generator
is the least score whose candidates and all above reach the wanted precision on
the other half.

Features are small integers, so all candidates are summed into cells of equal
features (one row per cell and half, at most the product of the feature
ranges, a few hundred in practice), and the fit reads the cells only.  The
trees become one SQL expression.  No Python runs on the executors.

Names of persons and street addresses are not proposed: nothing in the tables
could teach or calibrate them.

Defined cases: a null or empty text has no spans; rows that repeat each get a
row; a table without candidates adds no spans; positions are code points; of
overlapping spans all are reported, and the first by start, then kind, is
redacted; columns of any other name play no part and stay as they are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, let, quoted, whole_row

#: Kinds in order; the first four are the base, then one for each generator.
KINDS = ("email", "ip", "card", "phone", "number", "secret", "password", "iban", "ipv6")
BASE = KINDS[:4]
NUMBERS, TOKENS, NAMED_VALUES, ACCOUNTS, ADDRESSES = range(len(KINDS) - len(BASE))

# Runs begin where no longer run could: possessive loops and look-behind keep
# long runs linear, and possessive groups do not recurse.
_LOCAL = r"A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"
NUMBER = r"[+(]?[0-9][\x20().0-9-]{5,}[0-9]"
TOKEN = r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{16,}+"
_NAME = r"(?:token|secret|passw(?:or)?d|api[_-]?key|key)[\x22']?[\x20\t]{0,3}[=:][\x20\t]{0,3}[\x22']?"
NAMED = rf"(?i){_NAME}$"
NAMED_VALUE = rf"(?i)(?<={_NAME})[^\x00-\x20\x22',;]{{4,}}+"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"
ADDRESS = r"(?<![A-Za-z0-9:.])(?:[0-9A-Fa-f]{0,4}:){2,7}+[0-9A-Fa-f]{0,4}+(?![A-Za-z0-9:])"
#: Eight groups, or fewer about one double colon.
ADDRESS_FORM = r"^(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=(?:[^:]*:){3})(?!.*::.*::)(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)$"
CONTEXT = 20

_SPANS = "array<struct<s:int,e:int,m:string>>"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches with their places: what lies between matches, as
    ``split`` gives it, and the matches themselves add up to the places."""

    def placed(found: Column) -> Column:
        def walk(between: Column) -> Column:
            return F.aggregate(
                F.sequence(F.lit(0), F.size(found) - 1),
                F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPANS})").alias("out")),
                lambda acc, i: let(
                    acc["at"] + F.length(F.get(between, i)),
                    lambda s: F.struct(
                        (s + F.length(F.get(found, i))).alias("at"),
                        F.concat(acc["out"], F.array(F.struct(s.alias("s"), (s + F.length(F.get(found, i))).alias("e"), F.get(found, i).alias("m")))).alias("out"),
                    ),
                ),
                lambda acc: acc["out"],
            )

        return F.when(F.size(found) == 0, F.expr(f"cast(array() as {_SPANS})")).otherwise(let(F.split(text, pattern, -1), walk))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _none() -> Column:
    return F.expr(f"cast(array() as {_SPANS})")


def base_spans(text: Column) -> dict[str, Column]:
    """Valid spans per base kind; a failing match is dropped, not retried."""
    digits = lambda x: F.length(digits_of(x["m"]))
    return {
        "email": F.when(F.contains(text, F.lit("@")), matches(text, EMAIL)).otherwise(_none()),
        "ip": F.filter(matches(text, IP), lambda x: x["m"].rlike(OCTETS)),
        "card": F.filter(matches(text, CARD), lambda x: digits(x).between(12, 19) & F.when(digits(x).between(12, 19), F.call_function("luhn_check", digits_of(x["m"]))).otherwise(F.lit(False))),
        "phone": F.when(F.contains(text, F.lit("+")), F.filter(matches(text, PHONE), lambda x: digits(x).between(9, 15))).otherwise(_none()),
    }


def _bucket(value: Column, *edges: int) -> Column:
    out = F.lit(len(edges))
    for k, edge in reversed(list(enumerate(edges))):
        out = F.when(value < edge, k).otherwise(out)
    return out


#: Features, all small integers, in the order the trees know them.
FEATURES = ("gen", "chars", "digits", "letters", "hexadecimal", "separators", "lead", "check", "form", "quoted", "grouped")


def account_check(text: Column) -> Column:
    """Whether an account number leaves 1 by 97, its first four characters read last."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(plain.substr(F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    chars = F.transform(F.sequence(F.lit(1), F.length(plain)), lambda i: F.ascii(turned.substr(i, F.lit(1))))
    # A digit counts as one decimal place, a letter (A is 10) as two.
    return F.aggregate(chars, F.lit(0), lambda n, c: F.when(c < 65, (n * 10 + c - 48) % 97).otherwise((n * 100 + c - 55) % 97)) == 1


def _features(gen: int, x: Column, before: Column, after: Column) -> Column:
    m, d = x["m"], F.length(digits_of(x["m"]))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return F.struct(
        F.lit(gen).alias("gen"),
        _bucket(F.length(m), 9, 12, 16, 20, 32, 41).alias("chars"),
        _bucket(d, 1, 7, 9, 12, 16, 20).alias("digits"),
        flag(m.rlike("[A-Za-z]")).alias("letters"),
        flag(m.rlike("^[0-9a-fA-F]+$")).alias("hexadecimal"),
        _bucket(F.length(m) - F.length(F.regexp_replace(m, r"[\x20().-]", "")), 1, 3, 5).alias("separators"),
        F.when(F.startswith(m, F.lit("+")), 2).when(F.startswith(m, F.lit("(")), 1).otherwise(0).alias("lead"),
        (flag(account_check(m)) if gen == ACCOUNTS else F.when(d.between(12, 19), flag(F.call_function("luhn_check", digits_of(m)))).otherwise(0)).alias("check"),
        flag(m.rlike(ADDRESS_FORM if gen == ADDRESSES else OCTETS)).alias("form"),
        (flag(before.rlike(r"[\x22']$")) + flag(after.rlike(r"^[\x22']"))).alias("quoted"),
        flag(m.rlike(r"[0-9]{3,}[\x20.-][0-9]{3,}")).alias("grouped"),
    )


def candidates(text: Column) -> Column:
    """Spans of all generators with features and the naming context."""

    def described(gen: int, x: Column) -> Column:
        before = F.substring(text, F.greatest(x["s"] - CONTEXT, F.lit(0)) + 1, F.least(x["s"], F.lit(CONTEXT)))
        after = F.substring(text, x["e"] + 1, F.lit(1))
        return F.struct(
            x["s"].alias("s"), x["e"].alias("e"),
            F.coalesce(before.rlike(NAMED), F.lit(False)).alias("named"),
            _features(gen, x, before, after).alias("f"),
        )

    found = {
        NUMBERS: matches(text, NUMBER),
        TOKENS: F.filter(matches(text, TOKEN), lambda x: x["m"].rlike("[0-9]")),
        # A text without any of these has no such spans; the tests are plain searches.
        NAMED_VALUES: F.when(text.rlike(r"[=:]") & text.rlike(f"(?i){_NAME}"), matches(text, NAMED_VALUE)).otherwise(_none()),
        ACCOUNTS: F.when(text.rlike("[A-Z]{2}[0-9]{2}"), matches(text, ACCOUNT)).otherwise(_none()),
        ADDRESSES: F.when(text.rlike(":[0-9A-Fa-f]{0,4}:"), matches(text, ADDRESS)).otherwise(_none()),
    }

    def of(gen: int):
        return lambda x: described(gen, x)

    return F.concat(*[F.transform(spans, of(gen)) for gen, spans in found.items()])


def _ranked(rank: int):
    return lambda x: F.struct(x["s"].alias("s"), F.lit(rank).alias("r"), x["e"].alias("e"))


def _of_rank(rank: int):
    return lambda x: x["r"] == rank


def annotated(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, ``_base`` (array of (s, kind rank, e)), ``_cands`` and ``_half``."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(*keep, F.pmod(F.xxhash64("text"), F.lit(2)).alias("_half"), *[spans.alias(f"_{kind}") for kind, spans in base_spans(text).items()], candidates(text).alias("_cands"))
    ranked = [F.transform(f"_{kind}", _ranked(rank)) for rank, kind in enumerate(BASE)]
    return found.select(*keep, "_half", F.array_sort(F.concat(*ranked)).alias("_base"), "_cands")


def _held(base: Column, x: Column) -> Column:
    return F.exists(base, lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"]))


@dataclass(frozen=True)
class Trees:
    """Depth-2 trees as (feature, cut, (feature, cut, low, high) below, above),
    and a threshold for each generator."""

    bias: float
    trees: tuple
    thresholds: tuple

    def score(self, f: Column) -> Column:
        def side(node) -> Column:
            name, cut, low, high = node
            return F.when(f[name] <= cut, F.lit(low)).otherwise(F.lit(high))

        total = F.lit(self.bias)
        for name, cut, below, above in self.trees:
            total = total + F.when(f[name] <= cut, side(below)).otherwise(side(above))
        return total


def fit(rows: DataFrame, rounds: int = 20, rate: float = 0.4, precision: float = 0.98) -> Trees | None:
    """Boosted trees on the cells of one half, threshold from the other."""
    rows = rows.select("_half", "_base", F.explode_outer("_cands").alias("c")).where(F.col("c").isNotNull())
    gen, f = F.col("c.f.gen"), F.col("c.f")
    positive = (
        F.when(gen == NAMED_VALUES, (f["quoted"] > 0) | (f["digits"] > 0)).when(gen == ACCOUNTS, f["check"] == 1).when(gen == ADDRESSES, f["form"] == 1)
        .otherwise(F.col("c.named") | _held(F.col("_base"), F.col("c")))
    )
    rows = rows.select("_half", f.alias("f"), positive.cast("int").alias("y"))
    cells = rows.groupBy("_half", *[F.col(f"f.{n}").alias(n) for n in FEATURES]).agg(F.count("*").alias("n"), F.sum("y").alias("p")).collect()
    cells.sort(key=lambda r: tuple(r[n] for n in ("_half", *FEATURES)))
    train = [(tuple(r[n] for n in FEATURES), r["n"], r["p"]) for r in cells if r["_half"] == 0]
    check = [(tuple(r[n] for n in FEATURES), r["n"], r["p"]) for r in cells if r["_half"] == 1]
    total, positive = sum(n for _, n, _ in train), sum(p for *_, p in train)
    if not positive or positive == total:
        return None
    bias = math.log(positive / (total - positive))
    scores = [bias] * len(train)
    splits = [(k, cut) for k in range(len(FEATURES)) for cut in sorted({x[k] for x, *_ in train})[:-1]]
    trees = []

    def sums(members):
        g = h = 0.0
        for i in members:
            g, h = g + grad[i], h + hess[i]
        return g, h

    def best(members):
        (g, h), found = sums(members), None
        for k, cut in splits:
            gl, hl = sums([i for i in members if train[i][0][k] <= cut])
            gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
            if found is None or gain > found[0] + 1e-9:
                found = (gain, k, cut)
        return found

    def leaf(members):
        g, h = sums(members)
        return rate * g / (h + 1)

    everyone = range(len(train))
    for _ in range(rounds if splits else 0):
        prob = [1 / (1 + math.exp(-s)) for s in scores]
        grad = [p - n * q for (_, n, p), q in zip(train, prob, strict=True)]
        hess = [n * q * (1 - q) for (_, n, _), q in zip(train, prob, strict=True)]
        _, k, cut = best(everyone)
        sides = []
        for members in ([i for i in everyone if train[i][0][k] <= cut], [i for i in everyone if train[i][0][k] > cut]):
            _, k2, cut2 = best(members)
            low, high = leaf([i for i in members if train[i][0][k2] <= cut2]), leaf([i for i in members if train[i][0][k2] > cut2])
            for i in members:
                scores[i] += low if train[i][0][k2] <= cut2 else high
            sides.append((FEATURES[k2], cut2, low, high))
        trees.append((FEATURES[k], cut, *sides))
    model = Trees(bias, tuple(trees), ())
    of = lambda cells, gen: [c for c in cells if c[0][0] == gen]
    return Trees(bias, tuple(trees), tuple(_threshold(model, of(check, g) or of(train, g), precision) for g in range(len(KINDS) - len(BASE))))


def _score_one(model: Trees, x: tuple) -> float:
    at = dict(zip(FEATURES, x, strict=True))
    total = model.bias
    for name, cut, below, above in model.trees:
        n2, c2, low, high = below if at[name] <= cut else above
        total += low if at[n2] <= c2 else high
    return total


def _threshold(model: Trees, cells: list, precision: float) -> float:
    """Least score from which all candidates are as precise as wanted."""
    taken = right = 0
    out = math.inf
    rows = sorted(((_score_one(model, x), n, p) for x, n, p in cells), reverse=True)
    for k, (score, n, p) in enumerate(rows):
        taken, right = taken + n, right + p
        last = k + 1 == len(rows) or rows[k + 1][0] < score
        if last and right >= precision * taken:
            out = score
    return out - 1e-9 if math.isfinite(out) else out


def all_spans(base: Column, cands: Column, model: Trees | None) -> Column:
    """Base spans and those the model adds, by start, then kind."""
    if model is None or not any(map(math.isfinite, model.thresholds)):
        return base
    inside = lambda c: F.exists(base, lambda b: (b["s"] <= c["s"]) & (b["e"] >= c["e"]))
    least = F.array(*[F.lit(t) for t in model.thresholds])
    chosen = F.filter(cands, lambda c: ~inside(c) & (model.score(c["f"]) >= F.get(least, c["f"]["gen"])))
    return F.array_sort(F.concat(base, F.transform(chosen, lambda c: F.struct(c["s"].alias("s"), (c["f"]["gen"] + len(BASE)).alias("r"), c["e"].alias("e")))))


def detect(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns with ``base`` and ``spans`` (arrays of (s, r, e)).

    What is found is kept in the shared folder between the fit and the scores;
    if ``text`` is to be kept, texts are read twice rather than stored again.
    """
    if "text" in keep:
        model, rows = fit(annotated(docs)), annotated(docs, *keep)
    else:
        rows = durable(annotated(docs, *keep))
        model = fit(rows)
    return rows.select(*keep, F.col("_base").alias("base"), all_spans(F.col("_base"), F.col("_cands"), model).alias("spans"))


def written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["r"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    counts = [F.size(F.filter("base", _of_rank(r))).cast("long").alias(f"n_{kind}") for r, kind in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    found = detect(docs.select(whole_row(docs).alias("row"), "text"), "row", "text")
    pieces = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out")),
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["e"]).alias("at"),
            F.when(x["s"] >= acc["at"], F.concat(acc["out"], F.array(F.substring(F.col("text"), acc["at"] + 1, x["s"] - acc["at"]), F.get(names, x["r"])))).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.col("text").substr(acc["at"] + 1, F.length("text"))),
    )
    text = F.when(F.size("spans") > 0, pieces).otherwise(F.col("text"))
    return found.select(*[(text if c == "text" else F.col(f"row.{quoted(c)}")).alias(c) for c in docs.columns])
