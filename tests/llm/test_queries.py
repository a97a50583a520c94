"""Registered queries and the pipeline on the given tables."""

import hashlib
import random
import re

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from marketbars.llm import isolation, mixing, rules
from marketbars.llm import queries as llm

from .test_operators import brute_components, brute_hits, changed, edits

SF = "/root/testdata/sf0.01"


def test_every_operator_is_registered_once():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


def test_language_accuracy_on_held_out_documents(spark):
    found = llm.language_id(spark, SF).toPandas()
    lang = duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").df()
    both = found[found["held_out"]].merge(lang, on="doc_id")
    assert len(found) == len(lang)
    assert (both["lang_pred"] == both["lang"]).mean() > 0.97


def test_quality_of_held_out_documents(spark):
    found = llm.quality_classifier(spark, SF).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").df()
    both = found[found["held_out"]].merge(labels, on="doc_id")
    assert found["score"].between(0, 1).all()
    assert (both["predicted"] == both["quality"]).mean() > 0.9


def test_quality_rules_keep_good_documents(spark):
    found = llm.quality_rules(spark, SF).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").df()
    both = found[~found["base_failed"]].merge(labels, on="doc_id")
    assert both[both["quality"] == 1]["kept"].mean() > 0.98
    assert not found[found["base_failed"]]["kept"].any()


def test_quality_rules_reject_low_quality_of_other_labels(spark):
    """Thresholds from the labels of even ids judge the documents of odd ids."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = isolation.judge(docs, labels.where("doc_id % 2 = 0")).toPandas()
    both = found[~found["base_failed"]].merge(labels.where("doc_id % 2 = 1").toPandas(), on="doc_id")
    assert both[both["quality"] == 1]["kept"].mean() > 0.98
    assert both[both["quality"] == 0]["kept"].mean() < 0.2


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_sql(spark, name):
    from check import compare, connect

    same, note = compare(spark, connect(SF), SF, name)
    assert same, note


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination",
        "source mixing"]
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "copy"]
    assert 0 < out.select("doc_id").distinct().count() < docs.count()


# ------------------------ registered queries and the pipeline against plain Python

def allowed(a, b):
    return max(1, min(31, min(len(a), len(b)) // 20))


def plain_lines(rows, drop_emptied=False):
    """Texts without lines that equal an earlier one, or are near one, of the whole table."""
    seen, out = [], []
    equal = set()
    for i, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            near = len(line) >= 24 and any(abs(len(line) - len(m)) <= allowed(line, m) and edits(
                line, m) <= allowed(line, m) for m in seen)
            if line == "" or not (line in equal or near):
                kept.append(line)
            if line not in equal and len(line) >= 24:
                seen.append(line)
            equal.add(line)
        out.append((i, text, "\n".join(kept)))
    return [(i, new) for i, old, new in out if not drop_emptied or new == old or new.strip(" ") != ""]


def some_texts(count):
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(2, 18))) for _ in range(25)]
    out = []
    for k in range(count):
        found = [changed(rng, rng.choice(base), rng.choice((0, 0, 1, 4))) for _ in range(rng.randrange(1, 5))]
        out.append((k, "\n".join(found)))
    out[7] = (7, out[3][1])
    return out


def fixture_dir(spark, folder, rows):
    frame = spark.createDataFrame(
        [(i, t, "en", f"s{i % 2}", len(t)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_line_dedup_query_equals_plain_python(spark, tmp_path):
    rows = some_texts(40)
    got = {(r.doc_id, r.n_lines, r.n_chars_kept, r.kept_sha256) for r in contract.queries()[
        "op8_line_dedup"](spark, fixture_dir(spark, tmp_path, rows)).collect()}
    texts = dict(rows)
    assert got == {(i, texts[i].count("\n") + 1, len(t), hashlib.sha256(t.encode()).hexdigest())
                   for i, t in plain_lines(rows)}


def test_html_query_equals_plain_python(spark, tmp_path):
    rows, want = [], set()
    for k in range(90):
        body = [f"head {k}", *(f"paragraph {j} of page {k}" for j in range(2 + k % 4))]
        page = (f"<html><body><nav><a>menu</a></nav><div class=ad>buy {k}</div><article><h1>{body[0]}</h1>"
                + "".join(f"<p>{t}</p>" for t in body[1:]) + "</article><footer>end</footer></body></html>")
        url = f"http://h{k % 7 // 6}.org/{k}"
        rows.append((k, url, page))
        text = "\n\n".join(body)
        want.add((k, url, text, len(text)))
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = contract.queries()["op2_html_text"](spark, str(tmp_path)).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_secret_query_equals_plain_python(spark, tmp_path):
    rng = random.Random(9)
    parts = ["password=abcdef1", "token: x", "AKIA" + "Z9" * 8, "AKIA12", "0f" * 12, "0f" * 9,
             "api_key = 'q1w2e3r4'", "words", "é", "\n"]
    rows = [(k, " ".join(rng.choice(parts) for _ in range(rng.randrange(8)))) for k in range(60)]
    patterns = [("assign", r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
                ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]{24,}")]

    def plain(text):
        spans = [(m.start(), n, m.end(), kind) for n, (kind, p) in enumerate(patterns) for m in re.finditer(p, text)
                 if {"assign": lambda m: len(m[1]) >= 6, "access": lambda m: len(m[0]) >= 20,
                     "hex": lambda m: True}[kind](m)]
        return [(kind, a, b) for a, _, b, kind in sorted(spans)]

    want = set()
    for i, t in rows:
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(t))
        kinds = [k for k, _, _ in plain(t)]
        want.add((i, *(kinds.count(k) for k in ("assign", "access", "hex")),
                  hashlib.sha256(text.encode()).hexdigest(), text))
    got = contract.queries()["op10_secret_scan"](spark, fixture_dir(spark, tmp_path, rows)).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


def test_secret_query_scans_only_blobs_that_its_ledger_lacks(spark, tmp_path):
    query, name = contract.queries()["op10_secret_scan"], llm.SECRET_LEDGER
    folder = tmp_path / "ledger"
    one = fixture_dir(spark, tmp_path / "one", [(1, "password=abcdef"), (2, "words")])
    two = fixture_dir(spark, tmp_path / "two", [(1, "password=abcdef"), (3, "token=ghijkl")])
    spark.conf.set(name, str(folder))
    try:
        assert {r.doc_id: r.n_assign for r in query(spark, one).collect()} == {1: 1, 2: 0}
        runs = set(folder.iterdir())
        assert {r.doc_id: r.n_assign for r in query(spark, two).collect()} == {1: 1, 3: 1}
    finally:
        spark.conf.unset(name)
    added = [str(p) for p in set(folder.iterdir()) - runs]
    assert spark.read.parquet(*added).count() == 1


def test_pipeline_equals_plain_python(spark, tmp_path):
    rows = some_texts(40)
    sf = fixture_dir(spark, tmp_path, rows)
    spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int").write.parquet(
        f"{sf}/labels.parquet")
    items = [(0, " ".join(rows[5][1].split()[:13])), (1, "words that nobody wrote")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    # The classifier and the mixture draw by hash: their own results, kept by id, stand in for them.
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(corpus_pipeline.fold("doc_id", 5) != 0)
    good = {r.doc_id for r in rules.keep_good(docs, labels).collect()}
    assert good
    left = plain_lines([r for r in rows if r[0] in good], drop_emptied=True)
    first = {i for i, _, component in brute_components(left, 5, 80, 100) if i == component}
    left = [(i, t) for i, t in left if i in first]
    hit = {r[0] for r in brute_hits(left, items, 13) if r[-1]}
    left = [(i, t) for i, t in left if i not in hit]
    frame = spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t)) for i, t in left], docs.schema)
    want = sorted(map(tuple, mixing.mix(frame).collect()))
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()))
    assert got == want and got


def test_quality_labels_other_than_0_and_1_are_left_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    odd = labels.selectExpr("doc_id", "CASE WHEN doc_id % 3 = 0 THEN 2 WHEN doc_id % 3 = 1 THEN NULL ELSE -1 END AS quality")
    want, _ = rules.score(docs, labels)
    got, _ = rules.score(docs, labels.select("doc_id", "quality").unionByName(odd))
    assert {(r.doc_id, r.score) for r in got.collect()} == {(r.doc_id, r.score) for r in want.collect()}
    assert rules.keep_good(docs, labels.select("doc_id", "quality").unionByName(odd)).count() == rules.keep_good(
        docs, labels).count()
    only, ensemble = rules.score(docs, odd)
    assert not ensemble.weighted and {r.score for r in only.collect()} == {0.5}
