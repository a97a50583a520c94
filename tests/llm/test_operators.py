"""Operators against brute force on small tables, and their defined cases."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketbars.llm import (
    decontaminate,
    graph,
    html,
    isolation,
    jaccard,
    langid,
    lines,
    mixing,
    rules,
    secrets,
    substrings,
)

from .conftest import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def corpus(seed, docs, words=8, length=40, copies=0.5):
    """Random texts over few words, many of them slightly changed copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["É", "zß"]
    out = []
    for i in range(docs):
        if out and rng.random() < copies:
            text = rng.choice(out)[1].split(" ")
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
        else:
            text = [rng.choice(vocabulary) for _ in range(rng.randrange(1, length))]
        out.append((i * 3 + 1, " ".join(text)))
    return out


# ------------------------------------------------------------- n-gram join

def shingles(text, n):
    w = WORD.findall(lowered(text))
    if len(w) >= n:
        return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
    return {tuple(w)} if w else set()


def brute_components(rows, n, num, den):
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    return sorted(
        ((rows[k][0], len(sets[k]), min((i for i in groups[find(k)] if i is not None), default=None))
         for k in range(len(rows))), key=str)


@pytest.mark.parametrize("n,num,den,bucket,group,often", [
    (3, 90, 100, 4096, 1 << 22, 64),
    (5, 80, 100, 4096, 1 << 22, 64),
    (3, 80, 100, 3, 60, 2),  # blocks of a few members, nearly all shingles frequent
])
def test_join_equals_brute_force(documents, monkeypatch, n, num, den, bucket, group, often):
    monkeypatch.setattr(jaccard, "_RECURS", 1)
    rows = corpus(n + num, 90, words=14, length=60) + AWKWARD
    got = jaccard.classes(documents(rows), n, num, den, bucket_block=bucket,
                          group_block=group, recurs_in=often)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str)
    assert got == brute_components(rows, n, num, den)


def test_signatures_meet_for_all_linked_sets():
    import numpy as np

    rng = np.random.default_rng(5)
    for num in (50, 80, 90):
        limit = jaccard.Threshold(num, 100)
        for _ in range(300):
            size = int(rng.integers(2, 80))
            one = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
            change = int(rng.integers(0, 1 + size // 4))
            other = np.unique(np.concatenate([
                one[rng.permutation(len(one))[change:]],
                rng.integers(0, 1 << 62, int(rng.integers(0, 1 + size // 5))).astype(np.uint64)]))
            both = len(np.intersect1d(one, other))
            if not both or 100 * both < num * (len(one) + len(other) - both):
                continue
            universe = np.union1d(one, other)
            frequent = universe[rng.random(len(universe)) < rng.choice([0, 0.5, 1])]
            keys = [set(jaccard.signatures(s, frequent, limit).tolist()) for s in (one, other)]
            assert keys[0] & keys[1]


def test_one_of_each_keeps_smallest_ids_and_columns(documents):
    rows = [(5, "a b c d e f g"), (2, "a b c d e f g"), (9, "other text altogether of words"), (7, "")]
    df = documents(rows)
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7, 9]


def test_components_of_a_long_chain(spark):
    order = list(range(60))
    random.Random(3).shuffle(order)
    edges = [(a, b) for a, b in zip(order, order[1:])] + [(100, 101), (101, 100)]
    got = {r.node: r.root for r in graph.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(60), 0), 100: 100, 101: 100}


# ------------------------------------------------------------- substrings

def brute_repeats(rows, n):
    found = [WORD.findall(t or "") for _, t in rows]
    times = Counter(tuple(w[k:k + n]) for w in found for k in range(len(w) - n + 1))
    out = []
    for (i, _), w in zip(rows, found):
        gone = {j for k in range(len(w) - n + 1) if times[tuple(w[k:k + n])] > 1 for j in range(k, k + n)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk,bucket", [(1 << 20, 1 << 20), (300, 20)])
def test_substrings_equal_brute_force(documents, chunk, bucket):
    rows = corpus(2, 60, words=5) + AWKWARD
    got = substrings.remove_repeats(documents(rows), n=6, chunk_bytes=chunk, bucket_windows=bucket)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=str)
    assert got == brute_repeats(rows, 6)


# -------------------------------------------------------- decontamination

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(rows, items, n):
    windows = {}
    for i, t in items:
        w = ALNUM.findall(lowered(t))
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(i)
    out = []
    for i, t in rows:
        w = ALNUM.findall(lowered(t))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k:k + size])]
        listed = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), listed, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_hits_equal_brute_force(spark, documents, block):
    rows = [(i, t.replace(" ", ". ").upper()) for i, t in corpus(4, 50, words=6)] + AWKWARD
    items = [(k, t) for k, (_, t) in enumerate(corpus(9, 12, words=6, length=9))] + [
        (50, None), (51, ""), (None, "w1 w2 w3"), (3, "w1"), (52, "w4 w4 w4 w4 w4 w4 w4")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.judged(documents(rows), bench, n=4, block_bytes=block)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated)
                  for r in got.collect()), key=str)
    assert got == brute_hits(rows, items, 4)
    kept = decontaminate.without_contaminated(documents(rows), bench, n=4, block_bytes=block)
    assert kept.columns == documents(rows).columns
    assert kept.count() == sum(not g[-1] for g in got)


def test_hit_spans_are_cut(spark, documents):
    bench = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    cut = decontaminate.without_hit_spans(documents([(1, "A, b. C! é"), (2, None), (3, "d")]), bench)
    assert [r.text for r in cut.orderBy("doc_id").collect()] == ["A, ! é", None, "d"]


# ------------------------------------------------------------------ lines

def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def changed(rng, text, times):
    for _ in range(times):
        k = rng.randrange(len(text) + 1)
        text = rng.choice([text[:k] + "é" + text[k:], text[:k] + "b" + text[k + 1:], text[:k] + text[k + 1:]])
    return text


@pytest.mark.parametrize("errors", [1, 2, 3])
def test_banded_automaton_equals_edit_distance(spark, errors):
    rng = random.Random(errors)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(13)))
        pairs.append((a, changed(rng, a, rng.randrange(5))))
    got = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", lines.within(F.col("a"), F.col("b"), errors).alias("w")).collect()
    assert [r.w for r in got] == [edits(r.a, r.b) <= errors for r in got]


@pytest.mark.parametrize(("errors", "hot"), [(1, 16), (1, 1), (2, 1)])
def test_removed_lines_equal_brute_force(spark, monkeypatch, errors, hot):
    monkeypatch.setattr(lines, "HOT_LINES", hot)
    rng = random.Random(8)
    base = ["".join(rng.choice("abcd") for _ in range(rng.randrange(6, 16))) for _ in range(20)]
    docs = [(d, "\n".join(changed(rng, rng.choice(base), rng.randrange(3)) for _ in range(rng.randrange(6))))
            for d in range(30)] + [(None, "\n".join(base[:4])), (40, None), (41, "")]
    docs.append(docs[5])
    got = {(r.doc_key, r.pos) for r in lines.removed_lines(
        spark.createDataFrame(docs, "doc_id long, text string"), errors, 5).collect()}
    last = (1 << 63) - 1
    places = sorted({(last if i is None else i, p, line) for i, t in docs if t is not None
                     for p, line in enumerate(t.split("\n")) if len(line) >= 5})
    want = {(i, p) for k, (i, p, line) in enumerate(places)
            if any(edits(line, m) <= errors for _, _, m in places[:k])}
    assert got == want


def test_line_keys_are_dealt_once(spark, monkeypatch):
    """One exchange of the keys, and none that counts on being reused: on large tables it was not."""
    plans = {}

    def stored(df, name):
        found = df.sparkSession.createDataFrame(df.collect(), df.schema)
        plans[name] = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return found

    monkeypatch.setattr(lines, "stored", stored)
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh") for _ in range(60)) for _ in range(30)]
    docs = list(enumerate(base + [changed(rng, t, 2) for t in base]))
    got = {r.doc_key for r in lines.removed_lines(
        spark.createDataFrame(docs, "doc_id long, text string"), every=20).collect()}
    assert got == {k for k, t in docs if any(
        edits(t, m) <= min(len(t), len(m)) // 20 for _, m in docs[:k])}
    keys = [line for line in plans["shared-keys"].splitlines() if "Exchange hashpartitioning(key#" in line]
    assert len(keys) == 1


@pytest.mark.parametrize("hot", [16, 1])
def test_line_keys_are_dealt_in_parts(spark, monkeypatch, hot):
    """Parts of bounded size, whose shuffle is gone before the next is dealt: equal to brute force in all lengths."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, names, real = spark.conf.get(setting), [], lines.stored

    def stored(df, name):
        names.append((name, spark.conf.get(setting)))
        return real(df, name)

    monkeypatch.setattr(lines, "stored", stored)
    monkeypatch.setattr(lines, "KEYS_AT_ONCE", 12)
    monkeypatch.setattr(lines, "HOT_LINES", hot)
    rng = random.Random(13)
    base = ["".join(rng.choice("abcdeé\U0001d4b3 ") for _ in range(rng.choice((24, 41, 59, 80, 119, 160, 240))))
            for _ in range(25)]
    found = base + [changed(rng, t, rng.randrange(1, 3 + len(t) // 20)) for t in base for _ in range(3)]
    rng.shuffle(found)
    docs = list(enumerate(found))
    got = {r.doc_key for r in lines.removed_lines(
        spark.createDataFrame(docs, "doc_id long, text string"), every=20).collect()}
    assert got == {k for k, t in docs if len(t) >= 24 and any(
        len(m) >= 24 and edits(t, m) <= max(1, min(len(t), len(m)) // 20) for _, m in docs[:k])}
    parts = [removed for name, removed in names if name == "shared-keys"]
    assert len(parts) >= 3
    assert set(parts) == {"true"}
    assert spark.conf.get(setting) == before


def test_unlike_lines_shuffle_no_keys(spark, monkeypatch):
    """Lines that meet no other are dealt as a few runs of letters; none of their hundred keys is shuffled or kept."""
    rng = random.Random(21)
    rows = [("".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(400, 440))),) for _ in range(60)]
    kept, dealt, real_stored, real_runs = {}, [], lines.stored, lines.dealt_runs

    def stored(df, name):
        found = real_stored(df, name)
        kept[name] = found.count()
        return found

    def dealt_runs(*given):
        dealt.append(real_runs(*given))
        return dealt[-1]

    monkeypatch.setattr(lines, "stored", stored)
    monkeypatch.setattr(lines, "dealt_runs", dealt_runs)
    docs = [(k, t) for k, (t,) in enumerate(rows)]
    assert lines.removed_lines(spark.createDataFrame(docs, "doc_id long, text string"), every=20).count() == 0
    assert kept["shared-keys"] == 0
    assert sum(df.count() for df in dealt) <= 8 * len(docs)


def test_tables_between_steps_are_removed(spark, monkeypatch):
    """Only the lines and the near ones stay on the disk, so later stages have it."""
    tables, real = [], lines.stored

    def stored(df, name):
        tables.append((name, real(df, name)))
        return tables[-1][1]

    monkeypatch.setattr(lines, "stored", stored)
    rng = random.Random(22)
    base = ["".join(rng.choice("abcdefgh") for _ in range(90)) for _ in range(8)]
    docs = list(enumerate(base + [changed(rng, t, 3) for t in base for _ in range(3)]))
    gone = lines.removed_lines(spark.createDataFrame(docs, "doc_id long, text string"), every=20)
    assert gone.count() == 24
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    there = {name for name, df in tables for f in df.inputFiles()
             if hadoop(f).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop(f))}
    assert there == {"lines", "near"}


def test_lines_without_their_common_ends(spark):
    rng = random.Random(23)
    pairs = [("abc", "abc"), ("", "abc"), ("aaaa", "aa"), ("abcabc", "abc")]
    for _ in range(200):
        a = "".join(rng.choice("abé\U0001d4b3") for _ in range(rng.randrange(60)))
        pairs.append((a, changed(rng, a, rng.randrange(4))))
    found = spark.createDataFrame(pairs, "one string, other string").withColumn(
        "left", lines.between(F.col("one"), F.col("other"))).collect()
    for r in found:
        assert edits(r.left.a, r.left.b) == edits(r.one, r.other)
        assert not (r.left.a and r.left.b and (r.left.a[0] == r.left.b[0] or r.left.a[-1] == r.left.b[-1]))


def test_longer_lines_enter_a_shorter_class_by_their_own_segments(spark):
    """Of two lines of unlike classes only the shorter one looks for moved segments."""
    table = lines.window_table(spark, 479, 24, 1, 20).groupBy("class", "low").count().collect()
    windows = {(r["class"], r["low"]): r["count"] for r in table}
    assert windows[460, 440] < 0.5 * windows[440, 440]


def test_lines_within_one_edit_share_a_finer_hash(spark):
    rng = random.Random(4)
    pairs = [(a, changed(rng, a, 1)) for a in (
        "".join(rng.choice("abé") for _ in range(rng.randrange(1, 40))) for _ in range(300))]
    shared = F.arrays_overlap(*[lines.fine_hashes(F.col(c), F.length(c), 1) for c in "ab"])
    assert spark.createDataFrame(pairs, "a string, b string").where(~shared).count() == 0


def test_hot_key_of_unlike_lines(spark):
    """Lines with one common half: equal to brute force, with the key split."""
    rng = random.Random(5)
    half = "one half that all of these lines share, "
    tails = ["".join(rng.choice("abcdef") for _ in range(40)) for _ in range(60)]
    tails += [changed(rng, rng.choice(tails), rng.randrange(1, 3)) for _ in range(60)]
    docs = [(k, half + t) for k, t in enumerate(tails)]
    got = {r.doc_key for r in lines.removed_lines(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {k for k, t in docs if any(edits(t, m) <= 1 for _, m in docs[:k])}


@pytest.mark.parametrize("hot", [16, 1])
def test_threshold_grows_with_the_length(spark, monkeypatch, hot):
    """One error for 20 characters of the shorter line: equal to brute force, also on split keys."""
    monkeypatch.setattr(lines, "HOT_LINES", hot)
    rng = random.Random(11)
    letters = "abcdefghé "
    base = ["".join(rng.choice(letters) for _ in range(rng.choice((24, 39, 40, 61, 90, 130, 200)))) for _ in range(20)]
    base += [base[6] + "".join(rng.choice(letters) for _ in range(60)) for _ in range(6)]
    found = base + [changed(rng, t, rng.randrange(1, 3 + len(t) // 20)) for t in base for _ in range(2)]
    docs = list(enumerate(found))
    got = {r.doc_key for r in lines.removed_lines(
        spark.createDataFrame(docs, "doc_id long, text string"), every=20).collect()}
    want = {k for k, t in docs if len(t) >= 24 and any(
        len(m) >= 24 and edits(t, m) <= max(1, min(31, min(len(t), len(m)) // 20)) for _, m in docs[:k])}
    assert got == want
    assert len(want) > len({k for k, t in docs if any(edits(t, m) <= 1 for _, m in docs[:k])})


def test_line_dedup_text(documents):
    long_line = "a line of more than twenty-four characters"
    rows = [(1, f"{long_line}\nshort\n{long_line}"), (2, f"{long_line}!\nshort"), (3, long_line), (4, None)]
    got = {r.doc_id: r.text for r in lines.dedup_lines(documents(rows)).collect()}
    assert got == {1: f"{long_line}\nshort", 2: "short", 3: "", 4: None}
    assert {r.doc_id for r in lines.dedup_lines(documents(rows), drop_emptied=True).collect()} == {1, 2, 4}


def test_equal_short_lines_go(documents):
    rows = [(1, "short\n\nshort\nother"), (2, "short\nshorts\n\n"), (3, "other")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(documents(rows), exact_chars=1).collect()}
    assert got == {1: "short\n\nother", 2: "shorts\n\n", 3: ""}


# --------------------------------------------------------- rule statistics

def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    times = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    marked = {j for k in range(len(w) - 2) if times[tuple(w[k:k + 3])] > 1 for j in range(k, k + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(marked))


def test_statistics_equal_brute_force(documents):
    rows = AWKWARD + [(20, "a b c a b c # *x\n\na b\na b\n x \n x "), (21, "|é| " * 30)] + corpus(1, 20, words=3)
    got = isolation.statistics(documents(rows)).collect()
    assert [tuple(r) for r in got] == [(i, *brute_counts(t)) for i, t in rows]


def test_forest_tells_outliers_and_calibrates():
    import numpy as np

    rng = np.random.default_rng(0)
    usual, odd = rng.normal(0, 1, (500, 4)), rng.normal(9, 1, (20, 4))
    forest = isolation.grow(np.concatenate([usual, odd]), trees=50)
    good, bad = forest.score(usual), forest.score(odd)
    assert bad.min() > np.quantile(good, 0.99)
    threshold = isolation.calibrated(good, bad, rejected=0.02)
    assert (bad > threshold).mean() > 0.9 and (good > threshold).mean() <= 0.02
    assert isolation.calibrated(good, bad[:0]) == float("inf")


def statistics_table(spark, n, odd=()):
    """Statistics of ``n`` usual documents and their features; those of ``odd`` ids have many symbols."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    words = rng.integers(60, 400, n)
    counts = np.stack([words, words * 5 + rng.integers(0, 50, n), rng.integers(0, 4, n),
                       rng.integers(0, 3, n), rng.integers(0, 20, n)], axis=1)
    counts[list(odd), 2] = 300
    frame = pd.DataFrame(counts, columns=isolation.COUNTS)
    frame.insert(0, "doc_id", np.arange(n))
    return spark.createDataFrame(frame), isolation.features(counts)


def test_thresholds_take_every_label(spark, monkeypatch):
    """The only low-quality documents of 21,000 are those of the largest id hashes."""
    import numpy as np

    monkeypatch.setattr(isolation, "TREES", 8)
    monkeypatch.setattr(isolation, "SINGLE_TREES", 4)
    n = 21_000
    order = F.xxhash64(F.lit(isolation.SEED), "id").desc()
    odd = [r.id for r in spark.range(n).orderBy(order).limit(5).collect()]
    stats, rows = statistics_table(spark, n, odd)
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (~F.col("id").isin(odd)).cast("int").alias("quality"))
    over = np.flatnonzero(isolation.fit(stats, labels).excess(rows) > 0)
    assert set(odd) <= set(over.tolist()) and len(over) < len(odd) + 0.002 * n


def test_trees_count_every_document(spark):
    """Nodes of trees grown on a table have the lengths that counting all rows gives."""
    import numpy as np

    stats, rows = statistics_table(spark, 9_000, odd=[17])
    taken = [[0, 1, 2, 3], [1], [3]]
    forest = isolation._grown(stats.repartition(3, "doc_id"), taken).forest()
    for root, may in zip(forest.roots, taken, strict=True):
        depth, below, todo = {root: 0}, {root: np.arange(len(rows))}, [root]
        while todo:
            node = todo.pop()
            here = below[node]
            share = len(here) * isolation.SUBSET / len(rows)
            assert forest.length[node] == depth[node] + isolation._usual_path(share)
            f = forest.feature[node]
            if f < 0:
                assert share <= 1 or depth[node] == isolation.LEVELS or not np.ptp(rows[here][:, may], axis=0).any()
                continue
            assert f in may and here.size
            low = rows[here, f] < forest.value[node]
            for child, part in ((forest.left[node], here[low]), (forest.right[node], here[~low])):
                assert len(part)
                depth[child], below[child] = depth[node] + 1, part
                todo.append(child)
    # Dealt otherwise, the table gives the same trees.
    again = isolation._grown(stats.repartition(5), taken).forest()
    assert np.array_equal(forest.value, again.value) and np.array_equal(forest.length, again.length)


def test_judge_without_labels_uses_base_rules(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in isolation.judge(
        documents([(1, None), (2, " ".join(f"w{k}" for k in range(60)))]), labels).collect()}
    assert got == {1: False, 2: True}


def test_classifier_learns_rules_and_defined_cases(spark, documents):
    rng = random.Random(2)
    words = lambda n: [rng.choice("the of and some plain words".split()) for _ in range(n)]
    rows = [(k, " ".join(words(40)) + ".") for k in range(60)]
    rows += [(100 + k, "*** ".join(words(40))) for k in range(60)] + [(200, None), (201, "")]
    labels = [(i, int(i < 100), 0) for i, t in rows if t] + [(999, 1, 0), (1, None, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored, ensemble = rules.score(documents(rows), labels)
    got = {r.doc_id: r.score for r in scored.collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert min(got[k] for k in range(60)) > 0.5 > max(got[100 + k] for k in range(60))
    assert got[200] == got[201] and ensemble.weighted
    kept = rules.keep_good(documents(rows), labels)
    assert kept.columns == documents(rows).columns
    assert {r.doc_id for r in kept.collect()} >= set(range(60))
    none, _ = rules.score(documents(rows[:2]), labels.where("false"))
    assert [r.score for r in none.collect()] == [0.5, 0.5]


# ---------------------------------------------------------- language, mix

def test_language_of_held_out_texts(documents, spark):
    rng = random.Random(4)
    vocabulary = {"xx": ["kala", "mire", "tosun", "bela"], "yy": ["strug", "plench", "worft", "dring"]}
    rows = [(k, " ".join(rng.choice(vocabulary[lang]) for _ in range(20)), lang)
            for k, lang in enumerate(["xx", "yy"] * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = langid.learn(df.where("doc_id < 40"))
    assert sorted(known) == ["xx", "yy"]
    got = langid.predict(df.where("doc_id >= 40"), known).collect()
    assert all(r.lang_pred == rows[r.doc_id][2] and 0 <= r.score <= 1 for r in got)
    odd = langid.predict(documents(AWKWARD + [(30, "12 + 3 !")]), known).collect()
    assert len(odd) == len(AWKWARD) + 1
    assert [r.lang_pred for r in odd if r.doc_id in (1, 2, 3, 30)] == ["und"] * 4
    assert {r.lang_pred for r in langid.predict(df, {}).collect()} == {"und"}


def test_language_sample_merges_copies_and_reaches_into_texts(spark):
    """Copies take one place of the sample, and texts with one long header are told by their bodies."""
    head = "menu " * 400
    bodies = {k: " ".join(f"w{chr(97 + k)}{chr(97 + j % 26)}" for j in range(6000)) for k in range(20)}
    rows = [(head + t, "xx") for t in bodies.values()] + [(t, "yy") for t in bodies.values() for _ in range(200)]
    known = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert all(f"w{chr(97 + k)}a".encode() in known["yy"] for k in bodies)
    assert sum(f"w{chr(97 + k)}a".encode() in known["xx"] for k in bodies) >= 15


def test_mix_reaches_target_weights(spark):
    rows = [(k, "x" * 10, "big" if k % 10 else "small") for k in range(4000)]
    rows += [(None, "y" * 10, None), (5000, None, "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy", F.lit(1))
    mixed = mixing.mix(df, {"big": 1.0, "small": 1.0, None: 0.0})
    assert mixed.columns == [*df.columns, "copy_2"]
    share = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert set(share) == {"big", "small"}
    assert abs(share["big"] - 2000) < 200 and abs(share["small"] - 2000) < 200
    again = mixing.mix(df.repartition(5), {"big": 1.0, "small": 1.0})
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))
    assert mixing.mix(df.where("false")).count() == 0


# ------------------------------------------------------------ html, secrets

def test_html_main_text():
    page = ("<html><head><title>t</title><script>var a='<p>x</p>'</script></head><body><nav>menu</nav>"
            "<div class='cookie-notice'>ok?</div><article><h1>Head &amp; line</h1><p><b>One<br>two"
            "<p>Three\n four</article><section id=comments><p>nice</p></section><footer>f</footer>")
    assert html.extract([page, None, "", "plain text"]) == [
        "Head & line\n\nOne two\n\nThree four", "", "", "plain text"]


def host_page(k, inside="", article="<article>{}</article>"):
    body = "".join(f"<p>text {k} of paragraph {j}, long enough to be an article's text</p>" for j in range(3 + k % 3))
    return f"<html><body><nav>menu</nav>{article.format(f'<h1>head {k}</h1>{body}{inside}')}<footer>f</footer></body></html>"


def host_text(k):
    return "\n\n".join([f"head {k}", *(
        f"text {k} of paragraph {j}, long enough to be an article's text" for j in range(3 + k % 3))])


def test_repeated_part_without_a_listed_name_is_furniture():
    pages = [host_page(k, "".join(f"<div class=x12><div>buy {k * 7 + j}</div></div>" for j in range(3)))
             for k in range(12)]
    assert html.extract(pages) == [host_text(k) for k in range(12)]
    # Sections that hold most of the article are no furniture.
    pages = [host_page(k, "".join(f"<section>{'word ' * 100}{k * 7 + j}</section>" for j in range(3)))
             for k in range(12)]
    assert all(t.count("word") == 300 for t in html.extract(pages))


def test_odd_pages_do_not_spoil_the_template():
    layout = ("<div class=x1>side {k}</div><div class=content>{{}}</div><div class=x2>more {k} "
              + "links " * 5 + "</div>")
    pages = [host_page(k, article=layout.format(k=k)) for k in range(40)]
    pages[3] = "<html><body><div class=error><p>not found</p></div></body></html>"
    pages[5] = host_page(5, article=layout.format(k=5) + "<div class=content><p>second part</p></div>")
    got = html.extract(pages)
    assert [got[k] for k in range(40) if k not in (3, 5)] == [host_text(k) for k in range(40) if k not in (3, 5)]
    assert got[3] == "not found"
    assert got[5] == host_text(5) + "\n\nsecond part"


def test_names_do_not_drop_article_text():
    head = '<article class="overflow-hidden" data-state="hidden"><h1>head</h1><h2 id="related-work">Related</h2>'
    page = head + ('<section id="search-methods" aria-hidden="false"><p>methods</p></section>'
                   '<p hidden>gone</p><p style="color:red; display: none">gone</p></article>')
    assert html.extract([page]) == ["head\n\nRelated\n\nmethods"]
    assert html.extract(['<div id="search-methods"><h1>head</h1><p>text</p></div><div class="big menu">x</div>']) == [
        "head\n\ntext"]
    # With the evidence of the template, a listed word marks furniture inside the article too.
    pages = [host_page(k, f"<div class=share-box>share {k}</div>") for k in range(12)]
    assert html.extract(pages) == [host_text(k) for k in range(12)]
    once = [host_page(k, "<div class=share-box>values a share</div>" if k == 4 else "") for k in range(12)]
    assert html.extract(once)[4].endswith("values a share")


def test_html_queries_awkward_rows(spark):
    rows = [(1, "http://a.org/x", "<p>a</p>"), (1, "http://a.org/x", "<p>a</p>"), (2, None, None),
            (None, "http://A.org/y", "<div><p>b</div>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(str((r.page_id, r.text)) for r in html.main_texts(pages, group_pages=1).collect())
    assert got == sorted(str(x) for x in [(1, "a"), (1, "a"), (2, ""), (None, "b")])
    assert html.main_texts(pages.where("false")).count() == 0


def test_secret_spans():
    text = "é Password: 'abc123' token=ab; AKIA" + "Z9" * 8 + " " + "0f" * 12 + " secret=token: abcdef"
    spans = [(k, text[a:b]) for k, a, b in secrets.find(text)]
    assert spans == [("assign", "Password: 'abc123"), ("access", "AKIA" + "Z9" * 8), ("hex", "0f" * 12)]


def test_ledger_scans_each_blob_once(spark, documents, tmp_path):
    rows = AWKWARD + [(10, "password=abcdef"), (11, "password=abcdef"), (12, "-----BEGIN RSA PRIVATE KEY-----")]
    folder = str(tmp_path / "ledger")
    secrets.update_ledger(documents(rows), folder)
    blobs = secrets.ledger(spark, folder).count()
    assert blobs == len({hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows})
    more = [*rows, (13, "secret: 0123456789")]
    secrets.update_ledger(documents(more), folder)
    assert spark.read.option("recursiveFileLookup", "true").parquet(folder).count() == blobs + 1
    found = secrets.findings(documents(more), folder).collect()
    assert len(found) == len(more)
    assert {r.doc_id for r in found if r.findings} == {10, 11, 12, 13}


# -------------------------------------------------------------- empty tables

def test_empty_tables(spark, documents):
    empty = documents(AWKWARD).where("false")
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert jaccard.classes(empty).count() == 0
    assert substrings.remove_repeats(empty).count() == 0
    assert decontaminate.judged(empty, bench).count() == 0
    assert lines.dedup_lines(empty).count() == 0
    assert isolation.judge(empty, labels).count() == 0
    assert langid.predict(empty, langid.learn(empty)).count() == 0
    assert rules.score(empty, labels)[0].count() == 0
