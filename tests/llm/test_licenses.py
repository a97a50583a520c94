"""License scans against plain Python, and their rules and defined cases."""

import random
import re

import pytest

from marketbars.llm import licenses
from marketbars.llm.license_rules import RULES, Rule

from .conftest import AWKWARD
from .test_operators import lowered

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text, rules):
    """(n_words, {(first, last, rule number, stays)}) by full search of all pairs of matches."""
    words = WORD.findall(lowered(text))
    spaced = "".join(f" {w} " for w in words)
    found = []
    for r in rules:
        for m in re.finditer(licenses.spaced_pattern(r.pattern), spaced):
            first = spaced[:m.start()].count(" ") // 2
            found.append((first, first + m[0].count(" ") // 2, r))

    def beats(e, d):
        return e[0] <= d[0] and e[1] >= d[1] and (e[2].tier, e[1] - e[0], -e[2].number) > (
            d[2].tier, d[1] - d[0], -d[2].number) and e[2].tier >= d[2].tier

    return len(words), {(a, b, r.number, not any(beats(e, (a, b, r)) for e in found)) for a, b, r in found}


def expansions(pattern):
    """Texts that an expression of the rules' simple syntax matches: each choice at least once."""
    out = [""]
    rest = pattern
    while rest:
        if m := re.match(r"\(\?:((?:[^()]|\((?:[^()])*\))*)\)(\?)?", rest):
            # Bars within inner groups do not part the choices of this one.
            inner = [x for part in re.split(r"\|(?![^(]*\))", m[1]) for x in expansions(part)]
            choices = [*inner, *([""] if m[2] else [])]
        elif m := re.match(r"\[([^\]]*)\](\+|\?)?", rest):
            choices = [m[1][0], *([""] if m[2] == "?" else [])]
        elif m := re.match(r"(.)(\?)?", rest):
            choices = [m[1], *([""] if m[2] else [])]
        rest = rest[m.end():]
        out = [o + c for o in out for c in choices]
    return out


def test_keywords_and_stems_let_every_match_pass():
    assert len(RULES) > 250 and len({r.pattern for r in RULES}) == len(RULES)
    for r in RULES:
        texts = expansions(r.pattern)
        assert all(r.keyword in t and any(s in t for s in licenses.STEMS) for t in texts), r
        assert all(re.fullmatch(licenses.spaced_pattern(r.pattern), f" {t.replace(' ', '  ')} ") for t in texts), r


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_equal_plain_python(spark, documents, seed):
    rng = random.Random(seed)
    texts = [t for r in RULES for t in rng.sample(expansions(r.pattern), 1)]
    rows = []
    for k in range(150):
        parts = []
        for _ in range(rng.randrange(12)):
            one = rng.choice(texts).split(" ")
            cut = rng.randrange(len(one)) if rng.random() < 0.3 else 0
            parts.append(rng.choice([" ", "-", ", ", "\n"]).join(one[cut:]))
            parts.append(rng.choice(["", "Éa", "word", "MIT", "K", "license"]))
        rows.append((k, rng.choice([" ", ". ", "/"]).join(parts)))
    found = licenses.scan(documents(rows)).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        n, want = plain(texts[r.doc_id], RULES)
        assert r.n_words == n
        assert {(m["first"], m["last"], m["rule"], m["stays"]) for m in r.matches} == want


def test_many_matches_within_one_interval(spark, documents):
    """One long match contains more matches than the first reaches cover, and only it stays."""
    words = [f"w{k}" for k in range(120)]
    rules = [Rule(0, "whole", 3, "w0", " ".join(words), False),
             *[Rule(k + 1, f"l{k % 9}", 1 + k % 3, w, w, k == 5) for k, w in enumerate(words)]]
    text = " ".join(words)
    rows = [(1, text), (2, f"{text} {text} w1"), (3, " ".join(reversed(words)))]
    found = {r.doc_id: r for r in licenses.scan(documents(rows), rules=rules, stems="w").collect()}
    for i, t in rows:
        n, want = plain(t, rules)
        assert (found[i].n_words, {(m["first"], m["last"], m["rule"], m["stays"]) for m in found[i].matches}) == (
            n, want)
    assert [m["rule"] for m in found[1].matches if m["stays"]] == [0]
    short = {r.doc_id: r for r in licenses.summary(licenses.scan(documents(rows), rules=rules, stems="w")).collect()}
    assert (short[1].n_base, short[1].base_labels, short[1].labels, short[1].score) == (1, "l5", "l5,whole", 0.85)


def test_summary_of_base_phrases(spark, documents):
    rows = [(1, "Under the MIT license! cc-by-nc cc by nc; Apache License, Version 2.0"), (2, "sous mit licence"),
            (3, "GNU Affero General Public License v3")]
    got = {r[0]: tuple(r)[1:] for r in licenses.summary(licenses.scan(documents(rows))).collect()}
    assert got[1] == (15, 4, 0, 10, "apache-2,cc-by-nc,mit", "apache-2,cc-by-nc,mit", 0.85)
    assert got[2] == (3, 0, None, None, "", "mit", 0.7)
    assert got[3] == (6, 0, None, None, "", "agpl-3", 0.7)


def test_defined_cases(spark, documents):
    long_text = "under the mit license, " * 3000
    frame = documents([*AWKWARD, (10, long_text)])
    out = licenses.summary(licenses.scan(frame)).collect()
    assert len(out) == len(AWKWARD) + 1
    assert {r.labels for r in out if r.doc_id != 10} == {""}
    assert [(r.n_words, r.n_base, r.last_word, r.labels) for r in out if r.doc_id == 10] == [
        (12000, 3000, 11996, "mit")]
    assert {(r.doc_id, r.n_words) for r in out} >= {(1, 0), (2, 0), (3, 0), (None, 4), (4, 4), (5, 1), (6, 4)}
    assert licenses.summary(licenses.scan(frame.limit(0))).collect() == []
    plan = licenses.summary(licenses.scan(frame))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
