"""License scans: ordered signature rules over the words of a text, as column functions.

A text is lower-cased (A-Z) and read as words of letters, digits and everything
outside ASCII. ``license_rules`` has some hundred hand-written expressions.

1. Gate: a text without any of a few stems has no license. In the others a rule is
   tried only where its keyword occurs.
2. A rule's matches are marked in the text and found again among its words, which
   gives each its first word and the word after its last one, in one pass.
3. A match is suppressed if another one contains its interval and has a higher tier,
   or the same tier and a longer interval or, over the same interval, an earlier
   rule. Matches that only overlap both stay. Sorted by first word, what contains a
   match stands before it, at most as many places as matches begin within the
   longest interval of the text; only these are compared.

All of it is DataFrame functions within one row: nothing is shuffled and no Python
runs on the executors. The base phrases are rules too; whether suppressed or not,
they count and their labels stay.

Defined cases: null and empty texts have no words and no matches. Repeated rows each
get their result; null ids pass. Matches of one rule do not overlap one another, the
leftmost counts. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.license_rules import RULES, Rule

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Everything that is not part of a word, once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Every keyword contains one of these.
STEMS = ("licen", "public", "gpl", "bsd", "apache", "cc by", "commons", "mpl ", "software", "copy", "mit x11", "mit expat", "mit no",
         "redistribution", "distribution", "exception", "eclipse", "cddl", "zlib", "wtfpl", "cecill", "cc0",
         "openrail", "commercial", "consortium", "warranties", "promote", "advertising", "altered source",
         "invariant", "ofl", "asl 2", "as perl", "permission notice", "openssl", "ncsa", "rights reserved", "may not use")
#: How sure a match of each tier is.
WEIGHTS = {1: 0.5, 2: 0.7, 3: 0.85, 4: 0.95, 5: 1.0}
#: Places before a match that are compared, if that is enough; else all before it are.
REACHES = (8, 64, 512)

_RULE = "array<struct<number:int,label:string,tier:int,keyword:string,pattern:string,base:boolean>>"
_SPAN = ("array<struct<first:int,minus_last:int,minus_tier:int,rule:int,label:string,base:boolean>>")


def spaced_pattern(pattern: str) -> str:
    """A rule's expression for texts in which every word has a blank of its own on both sides."""
    optional = pattern.replace(" ?", "\0")
    return f" (?:{optional.replace(' ', '  ').replace(chr(0), '(?:  )?')}) "


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def lowered_words(text: Column) -> Column:
    """The words of a text in lower case, with one blank between them."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.trim(F.regexp_replace(low, SEPARATORS, " "))


def _places(spaced: Column, rule: Column) -> Column:
    """Structs of all matches of a rule that does match."""
    marked = F.regexp_replace(spaced, rule["pattern"], F.lit(" \x01$0\x02 "))
    words = F.split(F.concat(F.lit(" "), marked), " +")
    marks = F.filter(F.transform(words, lambda w, i: F.when(w.isin("\x01", "\x02"), i)),
                     lambda i: i.isNotNull())
    # Before the k-th mark stand an empty string, k marks, and words.
    edges = F.transform(marks, lambda i, k: i - k - 1)

    def spans(at: Column) -> Column:
        starts = F.filter(at, lambda _, k: k % 2 == 0)
        return F.transform(starts, lambda first, k: F.struct(
            first.alias("first"), (-F.get(at, 2 * k + 1)).alias("minus_last"),
            (-rule["tier"]).alias("minus_tier"), rule["number"].alias("rule"),
            rule["label"].alias("label"), rule["base"].alias("base")))

    return _bound(edges, spans)


def _spans(words: Column, rules: Sequence[Rule], stems: Sequence[str]) -> Column:
    """All matches in a text, sorted: what can suppress a match stands before it."""
    known = F.from_json(F.lit(json.dumps([
        {"number": r.number, "label": r.label, "tier": r.tier, "keyword": r.keyword,
         "pattern": spaced_pattern(r.pattern), "base": r.base} for r in rules])), _RULE)
    spaced = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))

    def found(text: Column) -> Column:
        tried = F.filter(known, lambda r: F.contains(words, r["keyword"]) & F.rlike(text, r["pattern"]))
        return F.array_sort(F.flatten(F.transform(tried, lambda r: _places(text, r))))

    gate = F.lit(False)
    for stem in stems:
        gate = gate | F.contains(words, F.lit(stem))
    return F.coalesce(F.when(gate, _bound(spaced, found)), F.array().cast(_SPAN))


def _reach(spans: Column, longest: Column) -> Column:
    """How many places before a match can hold one that contains it, if none has more than ``longest`` words."""
    def enough(reach: int) -> Column:
        close = F.transform(spans, lambda s, i: F.coalesce(
            F.get(spans, i + reach)["first"] - s["first"] < longest, F.lit(False)))
        return ~F.array_contains(close, True)

    out = F.size(spans)
    for reach in reversed(REACHES):
        out = F.when((F.size(spans) <= reach) | enough(reach), reach).otherwise(out)
    return out


def _judged(spans: Column, reach: Column) -> Column:
    """The matches as (first, last, tier, rule, label, base, stays)."""
    def one(span: Column, i: Column) -> Column:
        before = F.slice(spans, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, reach))
        suppressed = F.exists(before, lambda e: (e["minus_last"] <= span["minus_last"])
                              & (e["minus_tier"] <= span["minus_tier"]))
        return F.struct(
            span["first"].cast("long").alias("first"), (-span["minus_last"]).cast("long").alias("last"),
            (-span["minus_tier"]).alias("tier"), span["rule"].alias("rule"), span["label"].alias("label"),
            span["base"].alias("base"), (~suppressed).alias("stays"))

    return F.transform(spans, one)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         rules: Sequence[Rule] = RULES, stems: Sequence[str] = STEMS) -> DataFrame:
    """Per row: its id, its number of words, and all matches, suppressed ones included.

    Other rules need other ``stems``: each keyword must contain one.
    """
    rows = docs.select(F.col(doc_id).alias(doc_id), lowered_words(F.col(text)).alias("words"))
    blanks = F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit("")))
    rows = rows.select(
        doc_id, F.when(F.col("words") == "", 0).otherwise(blanks + 1).cast("long").alias("n_words"),
        _spans(F.col("words"), rules, stems).alias("spans"))
    longest = F.array_max(F.transform("spans", lambda s: -s["minus_last"] - s["first"]))
    rows = rows.select(doc_id, "n_words", "spans", longest.alias("longest"))
    rows = rows.select(doc_id, "n_words", "spans", _reach(F.col("spans"), F.col("longest")).alias("reach"))
    return rows.select(doc_id, "n_words", _judged(F.col("spans"), F.col("reach")).alias("matches"))


def labels_of(matches: Column) -> Column:
    """Distinct sorted labels, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")


def summary(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per row: places of base phrases, labels of base phrases and of all that stay, and the surest match."""
    matches = F.col("matches")
    base = F.filter(matches, lambda m: m["base"])
    stay = F.filter(matches, lambda m: m["base"] | m["stays"])
    weight = F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair])
    firsts = F.transform(base, lambda m: m["first"])
    return scanned.select(
        doc_id, "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        labels_of(base).alias("base_labels"), labels_of(stay).alias("labels"),
        F.coalesce(F.array_max(F.transform(stay, lambda m: weight[m["tier"]])), F.lit(0.0)).alias("score"))
