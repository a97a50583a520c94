"""Registered queries of this subpackage, and the SQL that some of them must equal.

Each query applies one operator, with its production parameters, to its whole
table and derives the columns asked for from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.llm import (
    codes,
    collocations,
    decontaminate,
    html,
    isolation,
    jaccard,
    langid,
    licenses,
    lines,
    mixing,
    rules,
    secrets,
    substrings,
)
from marketbars.llm.frames import fold
from marketbars.shared import run_dir

#: Session setting that names a shared folder for the ledger of repeated secret scans.
SECRET_LEDGER = "marketbars.secretLedger"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    dictionaries = langid.learn(docs.where(~held_out))
    found = langid.predict(docs, dictionaries)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "rejected")


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_texts(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.classes(table(spark, sf_dir, "documents"), n=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed",
                        F.sha2("kept_text", 256).alias("kept_sha256"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judged(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.concat_ws(",", F.array_sort("item_ids"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(listed, 256).alias("items_sha256"), "contaminated")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those taken out, and a digest of the text that is left."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.size(F.split("text", "\n")).alias("n_lines"))
    found = lines.dedup_lines(docs, every=lines.EVERY, exact_chars=lines.EXACT_CHARS)
    return found.select("doc_id", "n_lines", F.length("text").cast("long").alias("n_chars_kept"),
                        F.sha2("text", 256).alias("kept_sha256"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    scored, _ = rules.score(table(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= rules.THRESHOLD).cast("int").alias("predicted"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings per document; blobs in the ledger folder that ``SECRET_LEDGER`` names are not scanned again.

    Without that setting the ledger is a new, empty folder, and each blob is scanned once.
    """
    docs = table(spark, sf_dir, "documents")
    folder = spark.conf.get(SECRET_LEDGER, None) or run_dir(spark, "secret-ledger")
    secrets.update_ledger(docs, folder)
    found = secrets.findings(docs, folder)

    def times(kind: str):
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", times("assign").alias("n_assign"), times("access").alias("n_access"),
        times("hex").alias("n_hex"),
        F.sha2(secrets.spans_text("findings", secrets.BASE_KINDS), 256).alias("base_sha256"),
        secrets.spans_text("findings").alias("spans"))


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = codes.compress(table(spark, sf_dir, "embeddings"))
    rows = codes.with_label_error(found.rows)
    return rows.select("vec_id", "code", "error", "label_error",
                       F.lit(found.digest()).alias("codebooks_sha256"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def _reaching_workers(query: Callable[[SparkSession, str], DataFrame]):
    """Python workers of a local session look for this package where the driver has it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = str(Path(__file__).resolve().parents[2])
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_language_id": language_id,
        "op2_html_text": html_text,
        "op3_source_mix": source_mix,
        "op4_ngram_join": ngram_join,
        "op5_substring_dedup": substring_dedup,
        "op6_decontamination": decontamination,
        "op7_quality_rules": quality_rules,
        "op8_line_dedup": line_dedup,
        "op9_quality_classifier": quality_classifier,
        "op10_secret_scan": secret_scan,
        "op11_vector_codes": vector_codes,
        "op12_license_scan": license_scan,
        "op13_phrase_collocations": phrase_collocations,
    }
    return {name: _reaching_workers(q) for name, q in found.items()}


_LOWER = ("translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")
_SPACED = r"[^\x20\x09-\x0D]+"

SOURCE_MIX = f"""
WITH RECURSIVE sizes AS (
    SELECT source, CAST(sum(length(text)) AS DOUBLE) AS size FROM documents GROUP BY source
    HAVING sum(length(text)) > 0
), rates AS (
    SELECT source, sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes)
        * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes
), parts AS (
    SELECT source, greatest(1, CAST(ceil(rate / {mixing.PART_RATE}) AS BIGINT)) AS parts,
        rate / greatest(1, ceil(rate / {mixing.PART_RATE})) AS part_rate FROM rates
), sums AS (
    SELECT source, parts, part_rate, 0 AS k, exp(-part_rate) AS p, exp(-part_rate) AS below FROM parts
    UNION ALL
    SELECT source, parts, part_rate, k + 1, p * part_rate / (k + 1), below + p * part_rate / (k + 1)
    FROM sums WHERE k < ceil(part_rate + 12 * sqrt(part_rate) + 24)
), tables AS (
    SELECT source, parts, list(below) AS below FROM sums GROUP BY source, parts
), draws AS (
    SELECT d.doc_id, t.below, unnest(range(1, t.parts + 1)) AS part
    FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
), times AS (
    SELECT doc_id, sum(len(list_filter(below, lambda b: b <= (CAST('0x' || substr(md5(
        '{mixing.SEED}:' || doc_id || ':' || part), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0))) AS times
    FROM draws GROUP BY doc_id
)
SELECT d.*, CAST(unnest(range(1, CAST(times AS BIGINT) + 1)) AS INTEGER) AS copy
FROM documents d JOIN times USING (doc_id)
"""

NGRAM_JOIN = f"""
WITH RECURSIVE found AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '{_SPACED}') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1),
            lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM found
), flat AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.t = b.t AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
    (SELECT min(r.b) FROM reach r WHERE r.a = s.doc_id) AS component_id FROM sets s
"""

SUBSTRING_DEDUP = f"""
WITH found AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents
), starts AS (
    SELECT doc_id, w, unnest(range(1, len(w) - {substrings.WINDOW - 2})) AS i FROM found
), hashed AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + {substrings.WINDOW - 1}], ' ')) AS h FROM starts
), repeated AS (
    SELECT doc_id, i FROM hashed QUALIFY count(*) OVER (PARTITION BY h) > 1
), gone AS (
    SELECT doc_id, list(DISTINCT j) AS js FROM (
        SELECT doc_id, unnest(range(i, i + {substrings.WINDOW})) AS j FROM repeated) GROUP BY doc_id
)
SELECT f.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
    sha256(CASE WHEN js IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
        list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(js, j)),
            lambda j: w[j]), ' ') END) AS kept_sha256
FROM found f LEFT JOIN gone g USING (doc_id)
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATION = f"""
WITH found AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '{_ALNUM}') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '{_ALNUM}') AS w FROM benchmark
), windows AS (
    SELECT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS t FROM (
        SELECT item_id, w, least(13, len(w)) AS size,
            unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
), starts AS (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM found, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
), hits AS (
    SELECT doc_id, i, s.size, item_id
    FROM starts s JOIN windows v ON s.size = v.size AND array_to_string(s.w[i:i + s.size - 1], ' ') = v.t
), marked AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM (
        SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
        SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT f.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM found f LEFT JOIN marked m USING (doc_id) LEFT JOIN listed l USING (doc_id)
"""


def _vector_codes_sql() -> str:
    """One assignment and one new codebook per round, and an assignment at the end."""
    rounds = []
    for k in range(codes.ROUNDS + 1):
        rounds.append(f"""a{k} AS MATERIALIZED (
    SELECT vec_id, part, min(d) AS d, arg_min(entry, d * {codes.ENTRIES} + entry) AS entry FROM (
        SELECT p.vec_id, p.part, b.entry, CAST(list_sum(list_transform(range(1, len(p.v) + 1),
            lambda i: (p.v[i] - b.e[i]) * (p.v[i] - b.e[i]))) AS BIGINT) AS d
        FROM parts p JOIN b{k} b ON p.part = b.part) GROUP BY vec_id, part
)""")
        rounds.append(f"""b{k + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM b{k} b LEFT JOIN (
        SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM (
            SELECT part, entry, i, sum(x) AS s, count(*) AS n FROM (
                SELECT a.part, a.entry, unnest(p.v) AS x, unnest(range(len(p.v))) AS i
                FROM a{k} a JOIN parts p USING (vec_id, part)) GROUP BY part, entry, i)
        GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry
)""")
    last = codes.ROUNDS
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding,
        lambda x: CAST(floor({codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, part, v[part * (len(v) // {codes.PARTS}) + 1:(part + 1) * (len(v) // {codes.PARTS})] AS v
    FROM kept, range({codes.PARTS}) t(part)
), b0 AS MATERIALIZED (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS e FROM parts
    QUALIFY entry < {codes.ENTRIES}
), {", ".join(rounds[:-1])}, coded AS (
    SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code,
        CAST(sum(d) AS BIGINT) AS error FROM a{last} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM b{last})
        AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""

PHRASE_COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{collocations.UNKNOWN}') AS lang,
        unnest(regexp_split_to_array({_LOWER.format("text")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), found AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS MATERIALIZED (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM (
        SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM found, range(1, {collocations.LONGEST + 1}) t(k) WHERE len(w) >= k) GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang
), often AS MATERIALIZED (
    SELECT * FROM grams WHERE f >= {collocations.THRESHOLD}
), cuts AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut
    FROM often WHERE k >= 2
), scores AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, n,
        CAST(CAST(1000 AS HUGEINT) * c.a * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cuts c JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
    JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')
    JOIN totals t ON t.lang = c.lang
), best AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer FROM (
        SELECT lang, w, a, size, unnest(range(1, k - size + 2)) AS i FROM (
            SELECT lang, k, w, a, unnest(range(2, k)) AS size FROM cuts WHERE cut = 1))
    GROUP BY ALL
), kept AS (
    SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score FROM kept QUALIFY rank <= {collocations.TOP}
"""


def _license_scan_sql() -> str:
    """The same rules, with places counted from the blanks between matches and suppression as a self-join."""
    rules = ", ".join(
        f"({r.number}, '{r.label}', {r.tier}, '{r.keyword}', '{licenses.spaced_pattern(r.pattern)}', {r.base})"
        for r in licenses.RULES)
    weights = " ".join(f"WHEN {t} THEN {w}" for t, w in licenses.WEIGHTS.items())

    def words(pieces: str) -> str:
        joined = f"array_to_string({pieces}, '')"
        return f"((length({joined}) - length(replace({joined}, ' ', ''))) // 2)"

    return f"""
WITH rules(number, label, tier, keyword, pattern, base) AS (VALUES {rules}
), found AS MATERIALIZED (
    SELECT doc_id, trim(regexp_replace({_LOWER.format("text")}, '{licenses.SEPARATORS}', ' ', 'g'), ' ') AS w
    FROM documents
), hits AS MATERIALIZED (
    SELECT * FROM (SELECT doc_id, number, label, tier, base,
            string_split_regex(' ' || replace(w, ' ', '  ') || ' ', pattern) AS gaps,
            regexp_extract_all(' ' || replace(w, ' ', '  ') || ' ', pattern) AS hit
        FROM found JOIN rules ON contains(w, keyword)) WHERE len(hit) > 0
), spans AS MATERIALIZED (
    SELECT doc_id, number, label, tier, base, first, first + {words("[hit[i]]")} AS last FROM (
        SELECT *, {words("gaps[1:i]")} + {words("hit[1:i - 1]")} AS first FROM (
            SELECT *, unnest(range(1, len(hit) + 1)) AS i FROM hits))
), judged AS (
    SELECT *, NOT EXISTS (SELECT 1 FROM spans e WHERE e.doc_id = d.doc_id
        AND e.first <= d.first AND e.last >= d.last AND (e.tier > d.tier OR e.tier = d.tier AND (
            e.last - e.first > d.last - d.first OR e.last - e.first = d.last - d.first AND e.number < d.number))
        ) AS stays FROM spans d
), sums AS (
    SELECT doc_id, count(*) FILTER (base) AS n_base, CAST(min(first) FILTER (base) AS BIGINT) AS first_word,
        CAST(max(first) FILTER (base) AS BIGINT) AS last_word,
        array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
        array_to_string(list_sort(list(DISTINCT label) FILTER (base OR stays)), ',') AS labels,
        max(CASE tier {weights} END) FILTER (base OR stays) AS score
    FROM judged GROUP BY doc_id
)
SELECT doc_id, CASE WHEN w = '' THEN 0 ELSE length(w) - length(replace(w, ' ', '')) + 1 END AS n_words,
    coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
    coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM found LEFT JOIN sums USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_source_mix": SOURCE_MIX,
        "op4_ngram_join": NGRAM_JOIN,
        "op5_substring_dedup": SUBSTRING_DEDUP,
        "op6_decontamination": DECONTAMINATION,
        "op11_vector_codes": _vector_codes_sql(),
        "op12_license_scan": _license_scan_sql(),
        "op13_phrase_collocations": PHRASE_COLLOCATIONS,
    }
