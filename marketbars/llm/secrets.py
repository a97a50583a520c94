"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of a text is addressed by its SHA-256. The ledger holds, for each
blob and version of the rules, the spans found. A scan takes the blobs at hand
that the ledger does not have for the present rules, scans each once however
many paths or versions hold it, and adds them. Findings then join back to every
path by address.

The ledger is a Parquet folder with one file set per run; entries are only
added. A run that fails leaves no commit marker, so its files are not read, and
the next run scans those blobs again. The same blob scanned by two runs at once
gives equal entries, and readers take one of them.

Plan: texts shuffle once by address, after each task has merged its own copies,
so a text held by a third of all paths crosses once per task. Only addresses and
findings join back.

Defined cases: a null text is the empty text and has no findings. Spans are code
points, end exclusive, of the whole text. Repeated rows each get the findings of
their blob. Paths may be null. Empty tables give empty results. Extra columns are
not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.llm.frames import small_batches

#: Changes with the rules below; earlier findings then no longer count.
RULES_VERSION = "1"

#: The base kinds in their order, their patterns, and the shortest match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")
ASSIGN_VALUE = 6
ACCESS_LENGTH = 20

#: Kinds beyond the base: keys in armour, tokens with well-known heads, signed web tokens.
ADDED = {
    "private_key": re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    "hosted_token": re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})"),
    "web_token": re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
}
KINDS = (*BASE_KINDS, *ADDED)
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ADDED_HINTS = {"private_key": ("PRIVATE KEY",), "hosted_token": ("gh", "xox"), "web_token": ("eyJ",)}

_ENTRY = ("blob string, rules string, "
          "findings array<struct<kind:string,first:long,last:long>>")
_FINDINGS = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans of one text, by start, then by the order of kinds."""
    spans = []
    lowered = text.lower()
    if any(hint in lowered for hint in _ASSIGN_HINTS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
              if m.end() - m.start() >= ACCESS_LENGTH]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    for kind, pattern in ADDED.items():
        if any(hint in text for hint in _ADDED_HINTS[kind]):
            spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[{"kind": k, "first": a, "last": b} for k, a, b in find(t)]
                 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("blob"), pa.array([RULES_VERSION] * batch.num_rows, pa.string()),
             pa.array(found, _FINDINGS)], names=["blob", "rules", "findings"])


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Committed entries of the present rules, one per blob."""
    try:
        runs = spark.read.schema(_ENTRY).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException:  # no run has ended yet
        runs = spark.createDataFrame([], _ENTRY)
    return runs.where(F.col("rules") == RULES_VERSION).dropDuplicates(["blob"])


def addressed(texts: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """Every path with the address of its text, and the text."""
    content = F.coalesce(F.col(text), F.lit(""))
    return texts.select(F.col(path).alias("path"), F.sha2(content, 256).alias("blob"),
                        content.alias("text"))


def update_ledger(texts: DataFrame, folder: str, path: str = "doc_id", text: str = "text") -> None:
    """Scan the blobs of ``texts`` that the ledger lacks, and add them."""
    spark = small_batches(texts).sparkSession
    blobs = addressed(texts, path, text).select("blob", "text").dropDuplicates(["blob"])
    unseen = blobs
    known = ledger(spark, folder)
    if not known.isEmpty():
        unseen = blobs.join(known.select("blob"), "blob", "left_anti")
    unseen.mapInArrow(_scan, _ENTRY).write.parquet(f"{folder}/run-{uuid.uuid4().hex[:12]}")


def findings(texts: DataFrame, folder: str, path: str = "doc_id", text: str = "text") -> DataFrame:
    """Every path of ``texts`` with its blob and the spans the ledger has for it."""
    paths = addressed(texts, path, text).select("path", "blob")
    known = ledger(texts.sparkSession, folder).select("blob", "findings")
    # Blobs without findings need not travel; nor do their paths wait for any.
    known = known.where(F.size("findings") > 0)
    return paths.join(known, "blob", "left").select(
        F.col("path").alias(path), "blob",
        F.coalesce("findings", F.array().cast(known.schema["findings"].dataType)).alias("findings"))


def spans_text(findings_column, kinds: tuple[str, ...] = KINDS):
    """The spans of some kinds as kind:start:end, comma-joined."""
    chosen = F.filter(findings_column, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["first"].cast("string"), s["last"].cast("string"))))
