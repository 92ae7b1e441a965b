"""Language identification by compression.

Each language has a zstandard raw-content dictionary: whole texts of a bounded sample of its labelled rows. A text,
lower-cased as they are, is compressed with every dictionary, and the language of the smallest result wins; the margin to the runner-up, as a
share of its size, is the score, and a narrow one rejects the answer (``rejected``). Long texts are compressed in
blocks, each starting from the dictionary, so every part of a text counts and memory stays bounded.

Bounds of the sample, per language: ``SAMPLE_ROWS`` different texts, those with the smallest text hash, up to ``DICT_BYTES`` bytes. A
text of more than ``SAMPLE_CHARS`` characters gives so many of them, from its first letter on. Everything else covers all rows.

Defined results: ``und``, score 0, rejected, for null texts, texts without a letter, and where nothing was learned; with one language
learned the score is 0; ties go to the smaller language name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE_ROWS, SAMPLE_CHARS, DICT_BYTES = 96, 20_000, 112_640
BLOCK, LEVEL, NARROW = 8192, 9, 0.01
UNKNOWN = "und"


def dictionaries(labelled: DataFrame) -> dict[str, bytes]:
    """Language -> dictionary content, from ``labelled(lang, text)``; the bounded sample is all that reaches the driver."""
    start = F.when(F.length("text") > SAMPLE_CHARS, F.regexp_replace("text", r"^\P{L}+", "")).otherwise(F.col("text"))
    pieces = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", F.substring(start, 1, SAMPLE_CHARS).alias("text"))
    pieces = pieces.withColumn("fp", F.xxhash64("text"))
    places = pieces.select("lang", "fp").distinct().withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy("fp")))
    chosen = F.broadcast(places.where(F.col("place") <= SAMPLE_ROWS))  # numbers only; texts are not moved
    sample = pieces.join(chosen, ["lang", "fp"]).select("lang", "place", "text").distinct()
    content: dict[str, dict[str, None]] = {}
    for row in sample.orderBy("lang", "place", "text").collect():
        content.setdefault(row["lang"], {})[row["text"]] = None
    return {lang: "\n".join(texts).lower().encode()[:DICT_BYTES] for lang, texts in content.items()}


def sizes(text: bytes, compressors: list, block: int = BLOCK) -> list[int]:
    """Compressed bytes of the text by each compressor."""
    parts = [text[i:i + block] for i in range(0, len(text), block)]
    return [sum(len(c.compress(part)) for part in parts) for c in compressors]


def judged(text: str | None, names: list[str], compressors: list) -> tuple[str, float, bool]:
    """(language, score, rejected) of a text."""
    if not names or text is None or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    ranked = sorted(zip(sizes(text.lower().encode(), compressors), names, strict=True))
    score = (ranked[1][0] - ranked[0][0]) / ranked[1][0] if len(ranked) > 1 else 0.0
    return ranked[0][1], score, score < NARROW


def _predictions(content: dict[str, bytes], level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        names, compressors = sorted(content), []
        for name in names:
            known = zstandard.ZstdCompressionDict(content[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=level)
            compressors.append(zstandard.ZstdCompressor(
                level=level, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False))
        for batch in batches:
            found = [judged(text.as_py(), names, compressors) for text in batch.column("text")]
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(kept + columns, names=[*(c for c in batch.schema.names if c != "text"), "lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, content: dict[str, bytes], level: int = LEVEL) -> DataFrame:
    """doc_id and other columns of ``docs(text, ...)`` without the text, with lang_pred, score and rejected."""
    others = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "lang_pred string, score double, rejected boolean"])
    return docs.mapInArrow(_predictions(content, level), schema)
