"""Each digest query against plain Python, on a whole small table and on hard rows."""

import math
import os
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import chat, decontaminate, language, licenses, mixing, pii, quality_model, quality_rules, queries, similarity_join, url_rules
from sedimenta.llm.license_texts import TEMPLATES

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, s string, e string, h string, w string, key string, stack string"
LONG = "word and other words of a long text " * 4000
HARD = [
    None, "", " ", "\n\n", "a", "x y z", "one two three four five six seven eight " * 6,
    "The mit license, MIT License and Apache\nlicense. GNU General Public License v3 license",
    "mail a.b@c.de, x@y, u@v.w_x@y.zz ..d@e.f a@b.c..d@e.f + p@q.r-s.t@u.v",
    "ip 1.2.3.4 999.1.1.1 001.002.003.004 1.2.3.4.5.6.7.8 0256.1.1.1 10.0.0.255",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 378282246310005 12-34", "phone +1 (555) 123-4567 +12 +1234567890123456 +1..2..3..4..5..6..7..8..9",
    "é" * 30 + " ÉCOLE ÀÉ naïve token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" fin", "9" * 5000, "a." * 5000 + "@" + "b." * 5000 + "c",
    "tab\tand\x0bvertical\x0c form\rreturn \x00 nul \x7f del", "🙂 emoji 🙂🙂 4111111111111111 🙂", LONG, LONG + "end",
]


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, 0, "a", "b", "c", "d", "f", "g") for i, t in enumerate(HARD)]
    rows += [rows[6], rows[7], (None, "a null id and some words", None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(params=["hard", "docs", "empty"])
def any_docs(request, hard, docs):
    return {"hard": hard, "docs": docs, "empty": hard.limit(0)}[request.param]


def same(rows, wanted):
    assert sorted(map(repr, rows)) == sorted(map(repr, wanted))


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_quality_rules_base(any_docs):
    got = quality_rules.apply_rules(any_docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    same([(r["doc_id"], *[r[c] for c in names]) for r in got], [(d, *brute.base_rules(t)) for d, t in texts(any_docs)])
    assert not any(r["kept"] and r["base_failed"] for r in got)


@pytest.mark.parametrize("bound", [200_000, 0])  # broadcast and salted join
def test_quality_rules_lines(spark, monkeypatch, bound):
    monkeypatch.setattr(quality_rules, "MAX_BROADCAST_LINES", bound)
    shared = "all documents of this host share this very long line of text with many words"
    words = " ".join(f"w{k}" for k in range(25))
    rows = [(k, f"{shared}\nown {k} {words}", "h") for k in range(30)] + [(100, f"{shared}\nlittle of its own here now", "h")]
    rows += [(200 + k, f"copy {words}\ncopy {words} again", "h") for k in range(40)] + [(300, f"{shared}\n{words}", "other")]
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[3]["kept"] and got[3]["n_removed_words"] == len(shared.split()) and got[3]["clean_text"] == f"own 3 {words}"
    assert not got[100]["kept"] and not got[100]["base_failed"]
    assert all(got[200 + k]["n_removed_words"] == 0 for k in range(40))  # exact copies are one text
    assert got[300]["n_removed_words"] == 0 and got[300]["kept"]


def test_license_base(any_docs):
    got = licenses.report(licenses.scan(any_docs, "doc_id")).collect()
    same([tuple(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) for r in got], [(d, *brute.licenses(t)) for d, t in texts(any_docs)])
    assert all(0 <= r["score"] <= 1 for r in got)


def test_license_templates(spark):
    # Whole, with words dropped and added, cut in half, and repeated.
    whole = dict(TEMPLATES)["bsd"]
    w = whole.split()
    rows = [(1, f"x y z {whole} tail"), (2, " ".join(w[:30] + ["noise"] + w[30:50] + w[52:])), (3, " ".join(w[: len(w) // 3])), (4, f"{whole} between {whole}")]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()}
    assert [(s["start"], s["end"], s["label"]) for s in got[1]["spans"]] == [(3, 3 + len(licenses.tokens(whole)), "bsd")] and got[1]["spans"][0]["cover"] == 1.0
    assert [s["label"] for s in got[2]["spans"]] == ["bsd"] and 0.9 < got[2]["spans"][0]["cover"] < 1
    assert got[3]["spans"] == []
    assert [s["label"] for s in got[4]["spans"]] == ["bsd", "bsd"]


def test_license_kin(spark):
    """The closest licence is named, not its kin."""
    kin = {"agpl", "bsd", "bsd-3-clause", "cc-by", "cc-by-nc", "cc-by-nc-sa", "cc-by-nd", "gpl", "isc", "lgpl", "mit"}
    for label, text in TEMPLATES:
        if label in kin:
            spans = licenses.Scanner().scan(licenses.tokens(f"// file of ours {text} and so on"))[1]
            assert [s[2] for s in spans] == [label], (label, spans)
    changed = [("This work is licensed under a Creative Commons Attribution-Whatever 4.0 International License", []), ("This work is licensed under a Creative Commons Attribution 3.0 International License", [])]
    for text, want in changed:
        assert [s[2] for s in licenses.Scanner().scan(licenses.tokens(text))[1]] == want


def test_license_chains_by_hand():
    """Anchors, chains and the choice between them against plain loops, on texts cut from kin templates."""
    draw = random.Random(2)
    base = [draw.choice("abcdefghijklmnopqrstuvwxyz") * draw.randint(1, 2) for _ in range(60)]
    kin = [list(base), [w if k % 17 else "zz" for k, w in enumerate(base)], base[10:50] + ["q"] * 8, base[:20]]
    templates = [(f"t{k}", " ".join(w)) for k, w in enumerate(kin)]
    scanner = licenses.Scanner(templates, ())
    found_any = 0
    for _ in range(60):
        words = []
        for _ in range(draw.randint(1, 4)):
            part = list(draw.choice(kin))
            for _ in range(draw.randint(0, 4)):
                k = draw.randrange(len(part))
                part[k : k + draw.randint(0, 2)] = draw.choice([[], ["noise"], ["a", "b"]])
            words += part + ["other"] * draw.randint(0, 50)
        got = scanner.scan(words)[1]
        assert [(s, e, label, round(c, 9)) for s, e, label, c in got] == brute.license_spans(words, [licenses.tokens(t) for _, t in templates], [x for x, _ in templates])
        found_any += len(got)
    assert found_any > 60


def test_license_long_text():
    """Work grows with the text, not with its square."""
    import time

    text = [w for _, t in TEMPLATES for w in licenses.tokens(t)]
    took = []
    for times in (5, 20):
        began = time.process_time()
        assert len(licenses.Scanner().scan(text * times)[1]) >= 15 * times
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 1


def test_matching_statistics():
    scanner = licenses.Scanner((("a", "p q r p q s"), ("b", "q r t p q r p")), ())
    words = "p q r p q r t t p q s q r p p q r p q s".split()
    lists = ["p q r p q s".split(), "q r t p q r p".split()]
    joined = [" " + " ".join(x) + " " for x in lists]
    numbers = [scanner.numbers[w] for w in words]
    for place, length, state in scanner.statistics(numbers):
        best = max(n for n in range(place + 2) if any(" " + " ".join(words[place + 1 - n : place + 1]) + " " in j or n == 0 for j in joined))
        assert length == best
        for which, end in scanner.automaton.ends[state]:
            assert lists[which][end + 1 - length : end + 1] == words[place + 1 - length : place + 1]


def test_pii_base(any_docs):
    got = pii.report(pii.detect(any_docs, "doc_id")).collect()
    want = [(d, *brute.pii(t)) for d, t in texts(any_docs)]
    same([(r["doc_id"], [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]], r["base_sha256"]) for r in got], [x[:3] for x in want])
    spans = {d: w for d, _, _, w in want}
    assert all(set(spans[r["doc_id"]]) <= set(r["spans"].split(",")) for r in got if spans[r["doc_id"]])


def test_pii_learns_secrets(spark):
    import random

    rng = random.Random(5)
    secret = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    plain = lambda: " ".join(rng.choice(["the", "house", "of", "internationalisation2", "year 1999"]) for _ in range(30))
    rows = [(k, f'{plain()} token = "{secret()}" {plain()}' if k % 3 else plain()) for k in range(300)]
    rows += [(1000, f'{plain()} "{secret()}" {plain()}'), (1001, "a house of the year 1999 and internationalisation2"), (1002, "mail me@example.com now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.report(pii.detect(df, "doc_id")).collect()}
    assert got[1000].startswith("secret:") and got[1001] == "" and got[1002] == "email:5:19"
    assert sum("secret:" in got[k] for k in range(300)) == 200
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert clean[1002] == "mail [EMAIL] now" and clean[1001] == rows[301][1] and '"[SECRET]"' in clean[1]


def test_pii_candidates_and_scores(spark, docs, hard):
    """Generators, features and the choice again in Python, over documents and hard rows."""
    made = ["password = hunter2, key: the door, api_key='abcd'", 'Secret: "only letters here" token=' + "ab" * 20, "IBAN GB82 WEST 1234 5698 7654 32 or GB82WEST12345698765433", "at 12:34:56 2001:0db8:85a3:0000:0000:8a2e:0370:7334 and fe80::1:2:3 std::string a::b"]
    rows = docs.select("doc_id", "text").unionByName(hard.select("doc_id", "text")).unionByName(spark.createDataFrame([(9000 + k, t) for k, t in enumerate(made)], "doc_id long, text string"))
    noted = pii.annotated(rows, "doc_id", "text").collect()
    model = pii.fit(pii.annotated(rows, "doc_id"))
    scores = {}
    for r in noted:
        got = sorted((c["f"]["gen"], c["s"], c["e"], c["named"], *[c["f"][n] for n in pii.FEATURES[1:]]) for c in r["_cands"])
        assert got == sorted(brute.pii_candidates(r["text"])), r["text"]
        spans = [(b["s"], b["r"], b["e"]) for b in r["_base"]]
        for c in r["_cands"]:
            f = tuple(c["f"][n] for n in pii.FEATURES)
            if not any(b["s"] <= c["s"] and b["e"] >= c["e"] for b in r["_base"]) and pii._score_one(model, f) >= model.thresholds[f[0]] - 1e-9:
                spans.append((c["s"], f[0] + 4, c["e"]))
        scores.setdefault(r["doc_id"], []).append(",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans)))
    got = {}
    for r in pii.report(pii.detect(rows, "doc_id")).collect():
        got.setdefault(r["doc_id"], []).append(r["spans"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in scores.items()}


def test_pii_named_accounts_and_addresses(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))

    def iban():
        body = "".join(rng.choice("0123456789") for _ in range(18))
        return f"DE{98 - int(body + '131400') % 97:02d}{body}"

    rows = []
    for k in range(200):
        v6 = ":".join(f"{rng.randrange(65536):x}" for _ in range(8))
        rows.append((k, [f'my password = "{word()}" {word()}', f"the key: {word()} of it", f"pay {iban()} now", f"from {v6} at 10:20:30", f"pay DE00{'1' * 18} now"][k % 5]))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("s")).withColumn("base", F.lit(1)).withColumn("_half", F.lit(2)).withColumn("row", F.lit(3))
    clean = pii.redact(df)
    assert clean.columns == df.columns and clean.where("spans = 's' and base = 1 and _half = 2 and row = 3").count() == 200
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    for k, text in rows:
        want = [None, text, "pay [IBAN] now", "from [IPV6] at 10:20:30", text][k % 5]
        assert got[k] == want if want else got[k].startswith('my password = "[PASSWORD]" ')


def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op4_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(got) > 150 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)


def test_language_hard(hard, spark):
    model = language.fit(hard)
    got = {r["doc_id"]: r for r in language.predict(hard, model, "doc_id").collect()}
    assert got[0]["lang_pred"] == got[1]["lang_pred"] == "und" and got[13]["lang_pred"] == "und" and got[0]["score"] == 0
    assert got[18]["lang_pred"] == "en" and got[None]["lang_pred"] == "en"
    assert language.predict(hard.limit(0), model, "doc_id").count() == 0
    nothing = language.fit(hard.where("lang is null"))
    assert {r["lang_pred"] for r in language.predict(hard, nothing, "doc_id").collect()} == {"und"}


def test_language_counts_all_items(spark):
    labelled = spark.createDataFrame([(1, "a", "Hi, hi \U00020000b x"), (2, "b", "hi")], "doc_id long, lang string, text string")
    wanted = {}
    for lang, word in [("a", "hi"), ("a", "hi"), ("a", "\U00020000b"), ("a", "x"), ("b", "hi")]:
        for size, item in [(0, word)] + [(k, g) for k in range(1, language.LONGEST + 1) for g in language.grams_of(word, k)]:
            wanted[size, lang, item] = wanted.get((size, lang, item), 0) + 1
    assert {(r["size"], r["lang"], r["item"]): r["n"] for r in language.item_counts(labelled).collect()} == wanted


def test_language_keeps_uneven_languages(spark, monkeypatch):
    """Large languages leave room for a small one and for one whose words are clauses of count 1."""
    draw = random.Random(7)
    made = {lang: ["".join(draw.choice(letters) for _ in range(6)) for _ in range(400)] for lang, letters in (("big", "abcdefgh"), ("large", "ijklmnop"), ("rare", "qrstuvwx"))}

    def text(lang, n):
        if lang == "clauses":
            return "。".join("".join(draw.choice("天地玄黄宇宙洪荒日月盈昃") for _ in range(9)) for _ in range(4))
        return " ".join(draw.choice(made[lang]) for _ in range(n))

    rows = [(i, lang, text(lang, 60)) for i, lang in enumerate(["big"] * 120 + ["large"] * 120 + ["rare"] * 3 + ["clauses"] * 12)]
    items = language.item_counts(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    model = language.build(items, max_items=400, least_share=10)
    assert model.langs == ["big", "clauses", "large", "rare"]
    assert len(model.words.place) <= 450 and any(not w.isascii() for w in model.words.place)
    monkeypatch.setattr(language, "DENSE_FLOATS", 0)
    sparse = language.build(items, max_items=400, least_share=10)
    assert model.words.rows is not None and sparse.words.rows is None
    for lang, scorer in [(lang, language.Scorer(m)) for m in (model, sparse) for lang in model.langs]:
        assert [scorer.predict(text(lang, 8))[0] for _ in range(50)] == [lang] * 50


def test_language_by_hand(spark, docs, hard):
    """Counts, smoothing, backoff and scores again in plain Python."""
    rows = docs.select("doc_id", "lang", "text").unionByName(hard.select("doc_id", "lang", "text"))
    labelled = [(r["lang"], r["text"]) for r in rows.where(~language.held_out(F.col("doc_id"))).collect() if r["lang"] is not None and r["text"] is not None]
    predicted = brute.language_model(labelled, language.LONGEST, language.PRIOR)
    known = {}
    for r in language.predict(rows, language.fit(rows), "doc_id", "text").collect():
        want = known.setdefault(r["text"], predicted(r["text"]))
        assert r["lang_pred"] == want[0] and r["score"] == pytest.approx(want[1], abs=1e-3)


def test_language_backs_off():
    model = language.Model([{"lang": "a", "word": "lopetu", "n": 5}, {"lang": "b", "word": "mirzak", "n": 5}])
    assert language.Scorer(model).predict("lopetz petul")[0] == "a" and language.Scorer(model).predict("zakmir")[0] == "b"


def test_mixing(any_docs):
    got = mixing.mix(any_docs).collect()
    assert len(got) == any_docs.count()
    again = mixing.mix(any_docs.repartition(3)).collect()
    same(got, again)
    total, taken, largest = {}, {}, {}
    for r in got:
        key = (r["source_size"], r["target"])
        total[key] = r["target"]
        taken[key] = taken.get(key, 0) + r["size"] * r["copies"]
        largest[key] = max(largest.get(key, 0), r["size"])
        assert 0 <= r["copies"] <= 2
    if any_docs.count() > 100:
        for key, target in total.items():
            assert abs(taken[key] - target) <= max(0.05 * target, largest[key])
    rows = mixing.mixed_documents(any_docs)
    assert rows.columns == [*any_docs.columns, "copy"]
    same(rows.collect(), mixing.mixed_documents(any_docs.repartition(3)).collect())
    assert rows.count() == sum(r["copies"] for r in got)


def test_mixing_rows_keep_their_source(spark):
    """Equal ids and texts of several sources, rows equal in all columns, and names that clash."""
    rows = [(1, "x y z", c, c) for c in "abcd"] * 3 + [(None, "p q", None, "n")] * 5 + [(2, "p q r", "a", "1"), (2, "p q r", "a", "2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy string").withColumn("_n", F.lit(1)).withColumn("row", F.lit("r"))
    copies = {}
    for r in mixing.mix(df).collect():
        copies[r["target"], r["size"]] = copies.get((r["target"], r["size"]), 0) + r["copies"]
    got = mixing.mixed_documents(df)
    assert got.columns == [*df.columns, "copy_"]
    assert got.groupBy("source").count().count() == 5 and got.count() == sum(copies.values())
    assert all(r["source"] == (r["copy"] if r["copy"] in "abcd" else None if r["copy"] == "n" else "a") for r in got.collect())
    same(got.collect(), mixing.mixed_documents(df.repartition(5)).collect())


def test_mixing_targets_reshare(spark):
    sizes = spark.createDataFrame([("0a", 10, 1), ("0b", 500, 2), ("0c", 1000, 1), ("1", 50, 1)], "skey string, size long, n long")
    got = {r["skey"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    weight, cap = {"0a": 5, "0b": 2, "0c": 1, "1": 5}, {"0a": 20, "0b": 2000, "0c": 2000, "1": 100}
    want, goal, left = {}, 2060 * 1.5, set(weight)
    while True:
        level = (goal - sum(want.values())) / sum(weight[k] for k in left)
        over = {k for k in left if weight[k] * level > cap[k]}
        if not over:
            want |= {k: weight[k] * level for k in left}
            break
        want |= {k: float(cap[k]) for k in over}
        left -= over
    assert got == pytest.approx(want)


def test_quality_model(hard, docs, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = quality_model.classify(docs, labels)
    assert got.count() == docs.count()
    judged = got.join(labels, "doc_id").collect()
    good = [r for r in judged if r["quality"] == 1]
    assert sum(r["kept"] for r in good) >= 0.9 * len(good)
    assert sum(r["kept"] == (r["quality"] == 1) for r in judged) >= 0.85 * len(judged)
    few = labels.limit(0)
    assert quality_model.classify(hard, few).where("kept").count() == hard.count()
    two = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (4, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    assert quality_model.classify(hard, two).count() == hard.count()
    assert quality_model.classify(hard.limit(0), two).count() == 0


def test_quality_strengths(spark):
    """Prior counts that made the counts are found again; chance alone has none."""
    import numpy as np

    rng = np.random.default_rng(8)
    rows = []
    for h in range(1500):
        base = rng.beta(0.4 * 20, 0.6 * 20)
        for p in range(4):
            n = int(rng.integers(20, 60))
            rows.append((f"h{h}", f"p{p}", float(n), float(rng.binomial(n, rng.beta(base * 60, (1 - base) * 60)))))
    schema = "host string, path string, n double, good double"
    mean, hosts, paths = quality_model.strengths(spark.createDataFrame(rows, schema))
    assert abs(mean - 0.4) < 0.02 and 14 < hosts < 24 and 45 < paths < 80
    chance = [(h, p, n, float(rng.binomial(int(n), 0.4))) for h, p, n, _ in rows]
    assert min(quality_model.strengths(spark.createDataFrame(chance, schema))[1:]) > 500
    one = spark.createDataFrame([("h", "p", 10.0, 4.0)], schema)
    assert quality_model.strengths(one) == (0.4, quality_model.MOST_STRENGTH, quality_model.MOST_STRENGTH)


def test_quality_model_by_hand(spark, docs, sf_dir):
    """Every step again in plain Python: fit, sites without the document itself, odds."""
    import numpy as np

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = {r["doc_id"]: r for r in quality_model.classify(docs, labels).collect()}
    truth = {}
    for r in labels.where("quality is not null").collect():
        truth[r["doc_id"]] = min(r["quality"], truth.get(r["doc_id"], 1))
    rows = [r.asDict() | {"y": truth.get(r["doc_id"])} for r in quality_model.format_features(docs, "doc_id", "source", "lang").collect()]
    known = [r for r in rows if r["y"] is not None]
    x, y, beta = np.array([r["x"] for r in known]), np.array([r["y"] for r in known]), np.zeros(len(quality_model.FEATURES))
    ridge = np.array([1e-3] + [1.0] * (len(beta) - 1))
    for _ in range(200):  # Newton again, on the plain likelihood
        p = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(ridge), x.T @ (y - p) - ridge * beta)
    for r in rows:
        r["e"] = float(np.dot(r["x"], beta))
        r["p"] = 1 / (1 + math.exp(-r["e"]))
    worth = np.corrcoef([r["p"] for r in known], y)[0, 1] ** 2
    n, good = {}, {}
    for r in rows:
        r["n"], r["g"] = (1.0, float(r["y"])) if r["y"] is not None else (worth, worth * r["p"])
        for site in (("host", r["source"]), ("path", r["source"], r["lang"])):
            n[site], good[site] = n.get(site, 0) + r["n"], good.get(site, 0) + r["g"]

    def scatter(groups):
        total, g = sum(n[s] for s in groups), sum(good[s] for s in groups)
        m = g / total
        excess = sum(n[s] * (good[s] / n[s] - m) ** 2 for s in groups) - m * (1 - m) * (len(groups) - 1)
        return m, excess, m * (1 - m) * (total - len(groups) + 1 - sum(n[s] ** 2 for s in groups) / total)

    hosts = [s for s in n if s[0] == "host"]
    mean, *of_hosts = scatter(hosts)
    of_paths = np.sum([scatter([s for s in n if s[0] == "path" and s[1] == h[1]])[1:] for h in hosts], axis=0)
    strength = lambda excess, room: 1e6 if excess <= 0 or room <= 0 else min(1e6, max(0.5, room / min(excess, room) - 1))
    for r in rows:
        h, p = ("host", r["source"]), ("path", r["source"], r["lang"])
        k, j = strength(*of_hosts), strength(*of_paths)
        host = (good[h] - r["g"] + k * mean) / (n[h] - r["n"] + k)
        path = (good[p] - r["g"] + j * host) / (n[p] - r["n"] + j)
        odds = r["e"] + math.log(path / (1 - path)) - math.log(mean / (1 - mean))
        want = (r["p"], host, path, 1 / (1 + math.exp(-odds)))
        assert [got[r["doc_id"]][c] for c in ("model_score", "host_share", "path_share", "score")] == pytest.approx(want, rel=1e-5, abs=1e-9)


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?q#f", "https://example.org/en/12", "https://example.org/en/2", "https://a.b.example.org/en/1",
        "https://notexample.org/es/", "http://x.com/fr/", "http://x.com/fr", "http://com/de/1", "http://x.community/de/", "http://org", "http://org/", "http://a.org?x", "http://ÉX.org/é", "x://y.org/a://b.com/fr/",
        "http://org./", "http://.org/", "http://..org/x",
    ] * 2
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, key string, stack string")
    got = {r["page_id"]: r for r in url_rules.judge_urls(pages, url_rules.rules_frame(spark)).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = "", ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut].translate(brute.LOWER), rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for v, h, p in url_rules.DEFAULT_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow" if host else "block"))
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict), u
    assert url_rules.judge_urls(pages.limit(0), url_rules.rules_frame(spark)).count() == 0
    none = url_rules.judge_urls(pages, url_rules.rules_frame(spark).limit(0))
    assert none.where("rule is not null").count() == 0 and none.count() == len(urls)


def fitted(host, path, rules):
    """The longest fitting rule; ties by text, then verdict."""
    fits = [(len(h + p), (h + p), v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, "allow" if host else "block")


@pytest.mark.parametrize("bound", [200_000, 0])  # broadcast or joined carried stacks
def test_url_rules_nest(spark, monkeypatch, bound):
    """Deep nests of hosts and paths, letters of both cases, ties, repeated and useless rules, over many partitions."""
    monkeypatch.setattr(url_rules, "MAX_BROADCAST_CARRIED", bound)
    draw = random.Random(11)
    label, part = lambda: draw.choice("abc"), lambda: draw.choice(["x", "xy", "x/", "/", "y"])
    host = lambda most: ".".join(label() for _ in range(draw.randint(1, most))) + draw.choice([".com", ".org"])
    path = lambda most: "/" + "".join(part() for _ in range(draw.randint(0, most)))
    rules = [(draw.choice(["allow", "block"]), host(4), path(4)) for _ in range(300)]
    rules += [("allow", "com", "/x"), ("block", "com", "/x"), ("allow", "a.com", ""), ("block", "Example.ORG", "/Es/"), *rules[:5]]
    useless = [("block", None, "/"), ("block", "", "/"), ("block", "org", None), (None, "org", "/")]
    urls = [f"http://{host(6)}{path(6)}" for _ in range(500)] + ["http://example.org/Es/1", "http://sub.example.org/es/", "http://com/xy", "http://a.com", "http://com/xyz"]
    pages = spark.createDataFrame([(i // 2, u, "n", "r") for i, u in enumerate(urls)], "page_id long, url string, nodes string, row string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = url_rules.judge_urls(pages, spark.createDataFrame(rules + useless, url_rules.RULES)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    lowered = [(v, h.lower(), p) for v, h, p in rules]
    want = []
    for i, u in enumerate(urls):
        h, _, p = u[7:].partition("/")
        p = "/" + p if "/" in u[7:] else ""
        want.append((i // 2, h, p, *fitted(h, p, lowered)))
    same([tuple(r) for r in got], want)


def test_url_rules_many_of_one_host(spark):
    """10^5 rules under one host do not travel with its urls."""
    k = F.col("id")
    rules = spark.range(100_000).select(F.when(k % 2 == 0, "block").otherwise("allow").alias("verdict"), F.lit("com").alias("host"), F.concat(F.lit("/p"), k, F.lit("/")).alias("path"))
    pages = spark.range(20_000).select(k.alias("page_id"), F.concat(F.lit("http://h"), k % 7, F.lit(".com/p"), k * 5, F.lit("/q")).alias("url"))
    got = url_rules.judge_urls(pages, rules)
    wrong = (F.col("rule") != F.concat(F.lit("com/p"), F.col("page_id") * 5, F.lit("/"))) | (F.col("verdict") != F.when(F.col("page_id") % 2 == 0, "block").otherwise("allow"))
    assert got.where("rule is not null").count() == 20_000 and got.where(wrong).count() == 0
    assert got.agg(F.max(F.length("rule"))).first()[0] < 20


@pytest.mark.parametrize("bound", [500_000, 0])
def test_decontaminate(any_docs, spark, sf_dir, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", bound)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    items += [(900, "x y z"), (901, None), (902, "..."), (903, "École ÀÉ"), (904, "words of a long text word and other words of a long text word"), (905, "x y z")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    hits = decontaminate.window_hits(any_docs, bench)
    got = decontaminate.report(hits).collect()
    want = [(d, *brute.benchmark_hits(t, items)) for d, t in texts(any_docs)]
    same([tuple(r) for r in got], want)
    left = decontaminate.remove_documents(any_docs, bench)
    assert left.columns == any_docs.columns and left.count() == sum(not w[-1] for w in want)
    assert decontaminate.remove_documents(any_docs, bench.limit(0)).count() == any_docs.count()


HARD_TURNS = [
    (1, 0, "system", "be\\kind <turn user> \\l"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 3, "user", "</turn>\n<turn assistant>"), (1, 4, "assistant", "\\e\\\\ok>" * 50),
    (2, None, None, "x"), (2, 0, "assistant", "y"), (2, 0, "assistant", "y"), (3, 5, "assistant", "é🙂" * 9000), (3, 6, "a>b", "z"),
    *[(4, k, ("user", "assistant")[k % 2], f"turn {k} " * (k % 13)) for k in range(300)], (None, 0, "user", "who"), (6, 1, "user", "bb"), (6, 1, "user", "aaaaaaaa"), (6, 1, "user", "\\"), (6, 1, "user", "]"), (5, 0, "system", "s" * 9000), (5, 1, "assistant", "t"), (5, 2, "assistant", "u" * 900),
]


def test_chat(spark):
    df = spark.createDataFrame([(*r, "x") for r in HARD_TURNS], "conv_id long, turn long, role string, text string, windows string")
    formatted = chat.format_chat(df)
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    convs = {}
    for c, t, role, text in HARD_TURNS:
        convs.setdefault(c, []).append((t if t is not None else -1, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort(key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == brute.sha("".join(f"{r}\n{t}\n" for _, r, t in turns))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), brute.sha(loss))
    windows = chat.windows(formatted).where("conv_id = 4").orderBy("window").collect()
    assert len(windows) > 3 and all(len(w["text"]) / 4 <= chat.BUDGET for w in windows)
    assert any(w["n_repeated"] for w in windows)
    # The system turn leads each window of its conversation.
    assert all(w["text"].startswith("<turn system>") for w in chat.windows(formatted).where("conv_id in (1, 5)").collect())
    assert chat.read_back(chat.format_chat(df.limit(0))).count() == 0


def spans_of_turns(sizes, has_system, budget, history):
    """(start, end, first repeated) of each window by plain counting."""
    out, start, used, room = [], 0, 0, budget
    for i, size in enumerate(sizes):
        if i and used + size > room:
            out.append((start, i))
            start, used, room = i, 0, max(1, budget - history - (sizes[0] if has_system else 0))
        used += size
    out.append((start, len(sizes)))
    first = []
    for s, _ in out:
        f = s
        while f > int(has_system) and sum(sizes[f - 1 : s]) <= history and s:
            f -= 1
        first.append(f)
    return [(s, e, f) for (s, e), f in zip(out, first)]


def test_chat_windows(spark):
    """Windows against plain counting, with words as tokens, and a long conversation in linear time."""
    draw = random.Random(4)
    convs = {c: [("system" if c % 2 and not k else ("user", "assistant")[k % 2], " ".join(["w"] * draw.randint(0, 30))) for k in range(draw.randint(1, 60))] for c in range(30)}
    convs[99] = [(("user", "assistant")[k % 2], f"turn {k} " * (k % 7)) for k in range(30_000)]
    df = spark.createDataFrame([(c, k, r, t) for c, turns in convs.items() for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    formatted = chat.format_chat(df, budget=64, history=20, count=lambda w: F.size(F.split(w, " ")))
    got = {}
    for w in chat.windows(formatted).collect():
        got.setdefault(w["conv_id"], []).append((w["window"], w["text"].count("</turn>"), w["n_repeated"], [w["text"][s["start"] : s["start"] + s["length"]] for s in w["targets"]]))
    for c, turns in convs.items():
        sizes = [len(f"<turn {r}>{t}</turn>\n".split(" ")) for r, t in turns]
        want = []
        for k, (s, e, f) in enumerate(spans_of_turns(sizes, turns[0][0] == "system", 64, 20)):
            repeated = (s - f + (turns[0][0] == "system")) if s else 0
            want.append((k, e - s + repeated, repeated, [t for r, t in turns[s:e] if r == "assistant"]))
        assert sorted(got[c]) == want


@pytest.mark.parametrize("name", ["op1_quality_rules", "op5_mixing", "op7_url_rules", "op8_decontaminate", "op9_chat_format"])
def test_sql_agrees(spark, sf_dir, name):
    import glob

    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries.QUERIES[name](spark, sf_dir)
    want = con.sql(queries.SQL[name])
    order = sorted(df.columns)
    assert sorted(want.columns) == order
    same([tuple(r) for r in df.select(*order).collect()], want.select(*order).fetchall())


SEVERAL = [(1, "A a a a a a b"), (1, "B b b b c b d"), (3, "B b b b c b d"), (4, "A a a a a a b"), (None, "B b b b c b d"), (None, "only here and without a key"), (None, "only here and without a key"), (2, "C d e f g"), (2, "C d e f g"), (2, None), (2, None), (7, ""), (8, "a class of keys that a")]


def links_of(df):
    return df.select("doc_id", "class_id", "copy_of", "n_links").collect()


def test_similarity_join(any_docs):
    want = brute.similarity_classes(texts(any_docs))
    same([tuple(r) for r in links_of(similarity_join.join_texts(any_docs))], want)


def test_similarity_join_keys_that_repeat(spark):
    """Rows of one key and of none keep their texts; of each class one row stays."""
    df = spark.createDataFrame([(*r, k % 2, "r", "k") for k, r in enumerate(SEVERAL)], "doc_id long, text string, id int, root string, row_a string")
    got = similarity_join.join_texts(df)
    same([tuple(r) for r in links_of(got)], brute.similarity_classes(SEVERAL))
    assert got.where("class_key is not null").select("class_key").distinct().count() == len({t for _, t in SEVERAL if t})
    left = similarity_join.one_of_each_class(df)
    assert left.columns == df.columns
    same([(r["doc_id"], r["text"]) for r in left.collect()], [(1, SEVERAL[0][1]), (1, SEVERAL[1][1]), (None, SEVERAL[5][1]), (2, "C d e f g"), (2, None), (2, None), (7, ""), (8, SEVERAL[12][1])])
    same(left.collect(), similarity_join.one_of_each_class(df.repartition(3)).collect())


def test_similarity_join_large_groups(spark, monkeypatch):
    """Buckets over the leaf size, dense ones in several blocks, and a passage that many share."""
    import random

    monkeypatch.setattr(similarity_join, "LEAF", 20)
    monkeypatch.setattr(similarity_join, "BLOCK", 16)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base, passage = [word() for _ in range(150)], [word() for _ in range(30)]
    rows = []
    for k in range(120):  # near copies of each other, not all linked
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            w[rng.randrange(len(w))] = word()
        rows.append((k, " ".join(w)))
    rows += [(200 + k, " ".join(passage + [word() for _ in range(40)])) for k in range(150)]
    rows += [(500 + k, " ".join(base)) for k in range(30)]
    got = links_of(similarity_join.join_texts(spark.createDataFrame(rows, "doc_id long, text string")))
    same([tuple(r) for r in got], brute.similarity_classes(rows))


def test_similarity_join_recall(spark):
    """Links of every row against all rows; of the larger table named by RECALL_SF_DIR
    those of the rows whose id is divisible by 50."""
    folder = os.environ.get("RECALL_SF_DIR", "/root/testdata/sf0.01")
    step = 50 if "RECALL_SF_DIR" in os.environ else 1
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = {r["doc_id"]: r["n_links"] for r in similarity_join.join_texts(docs).collect()}
    sets = {r["doc_id"]: brute.shingle_set(r["text"]) for r in docs.collect()}
    holders = {}
    for s in set(sets.values()):
        for g in s:
            holders.setdefault(g, []).append(s)
    right = wanted = 0
    for d, s in sets.items():
        if d % step == 0 and s:
            common = Counter(id(o) for g in s for o in holders[g])
            sizes = {id(o): len(o) for g in s for o in holders[g]}
            links = sum(c >= 0.8 * (len(s) + sizes[o] - c) - 1e-9 for o, c in common.items()) - 1  # without itself
            right, wanted = right + min(found[d], links), wanted + links
            assert found[d] <= links
    print(f"recall {right} of {wanted}")
    assert wanted and right >= 0.9 * wanted


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(100, 101), (7, 7), (103, 101)], "a long, b long")
    got = {r["id"]: r["root"] for r in similarity_join.components(edges).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100, 103: 100}
