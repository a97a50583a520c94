"""Language ID by compression: one raw-content zstandard dictionary per language.

A text is encoded once with each language's dictionary; the language whose
encoding is smallest wins. Whole texts are encoded, in pieces of bounded length
so that the dictionary bears on all of a long text, and the sizes add up. Where
the margin is narrow (short texts, mixed texts) the words that a dictionary
holds decide among the near-equal languages, and ``rejected`` is set.

Learning: dictionaries are joined samples of labelled texts. At most
``SAMPLE_DOCS`` different texts per language (smallest text hashes) with at most
``SAMPLE_CHARS`` characters each, from a hashed place of the text, cut to
``DICTIONARY_BYTES``, come to the driver and are broadcast: bounded by the number
of languages. Every document is
predicted from its whole text, with no shuffle.

Texts are lower-cased and everything that is no letter becomes one blank, so
markup, digits and shouting do not count.

Defined cases: null texts and texts without a letter are ``und`` with score 0.
Without labelled texts all are ``und``. Null labels are not learned from.
Repeated rows are predicted alike. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marketbars.llm.frames import small_batches

SAMPLE_DOCS = 160
SAMPLE_CHARS = 1500
DICTIONARY_BYTES = 96 << 10
PIECE_BYTES = 4 << 10
#: Bytes within which encodings count as equally small, per piece of text.
NARROW_BYTES = 3
UNKNOWN = "und"

_BLANK = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def letters(text: str | None) -> bytes:
    """Lower-case letters of a text, other ASCII characters as single blanks; may be empty."""
    if not text or not any(map(str.isalpha, text)):
        return b""
    return b" ".join(text.lower().encode("utf-8", "ignore").translate(_BLANK).split())


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A dictionary per language from a bounded sample of its texts."""
    whole = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.xxhash64(text).alias("order"), F.col(text).alias("whole"))
    # The piece starts at a hashed place, from which SAMPLE_CHARS are left if the text has them.
    room = F.greatest(F.length("whole") - SAMPLE_CHARS, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("order"), room) + 1).cast("int")
    # Equal texts are merged before the limit, by their hashes alone; then the chosen ones are fetched.
    first = Window.partitionBy("lang").orderBy("order")
    chosen = whole.select("lang", "order").distinct().withColumn(
        "n", F.row_number().over(first)).where(F.col("n") <= SAMPLE_DOCS)
    sample = whole.join(F.broadcast(chosen), ["lang", "order"]).groupBy("lang", "n").agg(
        F.min(F.substring("whole", start, F.lit(SAMPLE_CHARS))).alias("piece"))
    joined: dict[str, list[bytes]] = {}
    for row in sample.orderBy("lang", "n").collect():
        joined.setdefault(row["lang"], []).append(letters(row["piece"]))
    found = {k: b" ".join(p for p in dict.fromkeys(v) if p)[:DICTIONARY_BYTES]
             for k, v in joined.items()}
    return {k: v for k, v in found.items() if v}


class Coders:
    """Compressors with one language's dictionary each, made once per task."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.names = sorted(dictionaries)
        self.words = [frozenset(dictionaries[k].split()) for k in self.names]
        self.coders = []
        for k in self.names:
            data = zstandard.ZstdCompressionDict(
                dictionaries[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            # Short matches count: words share short parts within a language.
            params = zstandard.ZstdCompressionParameters(
                window_log=18, hash_log=17, chain_log=17, search_log=3, min_match=3,
                strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0,
                write_dict_id=0)
            self.coders.append(zstandard.ZstdCompressor(
                dict_data=data, compression_params=params))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the margin was too narrow."""
        content = letters(text)
        if not content or not self.names:
            return UNKNOWN, 0.0, True
        parts = [content[k:k + PIECE_BYTES] for k in range(0, len(content), PIECE_BYTES)]
        sizes = np.array([sum(len(c.compress(p)) for p in parts) for c in self.coders])
        order = np.argsort(sizes, kind="stable")
        best = int(order[0])
        if len(order) == 1:
            return self.names[best], 1.0, False
        margin = int(sizes[order[1]] - sizes[best])
        narrow = margin < NARROW_BYTES
        near = np.flatnonzero(sizes < sizes[best] + NARROW_BYTES)
        share = 1 / (1 + np.exp(-margin / 2))
        if narrow:
            tokens = content.split()
            known = [sum(t in self.words[k] for t in tokens) - sizes[k] / NARROW_BYTES for k in near]
            best = int(near[int(np.argmax(known))])
            share = 0.5
        return self.names[best], float(share), narrow


def predict(docs: DataFrame, dictionaries: dict[str, bytes], doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """Per document: language, score, and whether the margin was too narrow."""
    shared = small_batches(docs).sparkSession.sparkContext.broadcast(dictionaries)
    schema = T.StructType([
        docs.schema[doc_id], T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = Coders(shared.value)
        for batch in batches:
            found = [coders.predict(t) for t in batch.column(text).to_pylist()]
            lang, score, narrow = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(doc_id), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(narrow, pa.bool_())], names=schema.names)

    return docs.select(doc_id, text).mapInArrow(encode, schema)
