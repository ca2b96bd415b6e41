"""The pipeline's stages, each against what it promises on its own input."""

import corpus_pipeline
from sedimenta.llm import mixing

from . import brute


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "pii", "mix"]
    stage = dict(corpus_pipeline.STAGES)

    spoken = stage["language"](spark, docs, sf_dir)
    assert spoken.columns == columns
    before, after = rows_of(docs), rows_of(spoken)
    lost = [d for d in before if d not in after]
    assert len(lost) <= 0.05 * len(before)
    assert all(any(c.isalpha() for c in r["text"]) for r in after.values())

    single = stage["near_duplicates"](spark, spoken, sf_dir)
    assert single.columns == columns
    classes = brute.similarity_classes([(d, r["text"]) for d, r in after.items()])
    kept = rows_of(single)
    assert set(kept) == {c for _, c, _, _ in classes}

    clean = stage["decontaminate"](spark, single, sf_dir)
    left = rows_of(clean)
    assert set(left) == {d for d, r in kept.items() if not brute.benchmark_hits(r["text"], bench)[-1]}

    safe = rows_of(stage["pii"](spark, clean, sf_dir))
    assert set(safe) == set(left)
    for d, r in safe.items():
        assert brute.pii(r["text"])[0] == [0, 0, 0, 0]
        assert r["n_chars"] == len(r["text"])
        if not brute.pii(left[d]["text"])[2] and "token" not in left[d]["text"]:
            assert r["text"] == left[d]["text"]

    mixed = stage["mix"](spark, clean, sf_dir)
    wanted = {}
    for r in mixing.mix(clean).where("copies > 0").collect():
        wanted[r["doc_id"]] = wanted.get(r["doc_id"], 0) + r["copies"]
    got = {}
    for r in mixed.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
        assert r["text"] == left[r["doc_id"]]["text"]
    assert got == wanted


def test_language_stage_keeps_known_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    after = rows_of(corpus_pipeline.language_stage(spark, docs, sf_dir))
    assert {d for d, r in before.items() if r["lang"] is not None and any(map(str.isalpha, r["text"] or ""))} <= set(after)
    # Evenly shared words leave every language at a quarter; the text is clean all the same.
    rows = [(k, "shared words", lang, "s", 12) for k, lang in enumerate("abcd" * 8)] + [(100, "words", None, "s", 5), (101, "\u0416\u0416\u0416", None, "s", 3), (102, "1 2", "a", "s", 3)]
    few = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in corpus_pipeline.language_stage(spark, few, sf_dir).collect()} == {*range(32), 100}


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns[-1] == "copy" and out.count() > 100


def test_stages_on_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


CLASHES = ("n", "id", "score", "lang_pred", "_p", "spans", "base", "_half", "_name", "_n", "copy", "row", "row_a", "root", "text_key", "kind", "path")


def test_stages_on_hard_rows(spark, sf_dir):
    """Nulls, empty texts, ids that repeat, and columns called as the stages' own."""
    texts = ["some of the words that many documents have in them", "other words of the same length that nobody else wrote down", "a third text with more words than the first one had"]
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (3, texts[0], None, "b", 1), (4, texts[0].upper(), "en", None, 1), (4, texts[1], "en", "b", 1), (4, texts[1], "en", "b", 1), (None, texts[2], "en", "b", 1), (4, texts[2], "en", "c", 1)]
    docs = spark.createDataFrame([(*r, *CLASHES) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES))
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == (columns if name != "mix" else [*columns, "copy_"])
        got = docs.collect()
        assert all(r[c] == c for r in got for c in CLASHES)
        kept.append(sorted({(r["doc_id"] or 0, r["text"]) for r in got}))
        docs = spark.createDataFrame(got, docs.schema)
    assert kept[0] == sorted([(0, texts[2]), (3, texts[0]), (4, texts[0].upper()), (4, texts[1]), (4, texts[2])])
    assert kept[1] == kept[2] == kept[3] == sorted([(3, texts[0]), (4, texts[1]), (4, texts[2])])
    assert set(kept[4]) <= set(kept[3])
