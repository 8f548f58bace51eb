"""Language identification by compression with per-language dictionaries.

A language's dictionary is raw text of the language. A text is compressed part by part with every
dictionary, and the language whose dictionary gives the fewest bytes is chosen. A narrow margin between
the two best is a reason to reject.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.names import unused_name

UNKNOWN = "und"
SAMPLE_ROWS = 128  # texts of each language that its dictionary is made of, at most
SAMPLE_CHARS = 512  # characters taken from each, at a hashed place
LANGUAGES = 1000  # learned values of lang, the commonest ones
DICTIONARY_CHARS = 200 * SAMPLE_ROWS * SAMPLE_CHARS  # of all languages together
PART = 1024  # bytes that are compressed together; all parts of a text are
LEVEL = 6
MARGIN_BYTES = 64  # a shorter text needs one byte between the two best sizes, whatever its margin

RESULT = "lang string, score double, margin double"


def dictionaries(
    docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, languages: int = LANGUAGES, most_chars: int = DICTIONARY_CHARS
) -> dict[str, bytes]:
    """Raw text per value of ``lang``, commonest language first.

    Rows with a null ``lang`` or ``text`` are left out. The texts are chosen by a hash of the id, so the
    size is bounded by ``rows * chars`` characters a language and by ``most_chars`` in all, whatever the number of
    documents: where there are many languages, each has fewer rows, but one at least. Of more than ``languages``
    values the commonest are learned, ties by name; texts of the others get one of those.
    """
    known = docs.where("lang is not null and text is not null")
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    rows = max(1, min(rows, most_chars // (chars * max(1, len(counts)))))
    if len(counts) == languages:
        known = known.where(F.col("lang").isin([c["lang"] for c in counts]))
    pick = F.xxhash64("doc_id")
    start = F.pmod(pick, F.greatest(F.length("text") - chars, F.lit(0)) + 1) + 1
    piece = F.lower(F.substring("text", start.cast("int"), F.lit(chars)))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("pick", "piece"))
    chosen = (
        known.select("lang", pick.alias("pick"), piece.alias("piece"))
        .withColumn("nth", nth)
        .where(F.col("nth") <= rows)
        .orderBy("lang", "nth")
        .collect()
    )
    pieces: dict[str, list[str]] = {c["lang"]: [] for c in counts}
    for r in chosen:
        pieces[r["lang"]].append(r["piece"])
    return {lang: "\n".join(own).encode() for lang, own in pieces.items()}


class Compressors:
    """One compressor per language; the order of the languages decides ties."""

    def __init__(self, raw: dict[str, bytes], level: int = LEVEL):
        self.by_language = {}
        for lang, data in raw.items():
            words = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(
                level, source_size=PART, dict_size=len(data),
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            self.by_language[lang] = zstandard.ZstdCompressor(dict_data=words, compression_params=how)

    def sizes(self, text: str) -> dict[str, int]:
        """Compressed bytes of the whole text in each language."""
        data = text.lower().encode()
        parts = [data[at : at + PART] for at in range(0, len(data), PART)]
        return {
            lang: sum(len(c.compress(p)) for p in parts) for lang, c in self.by_language.items()
        }

    def identify(self, text: str | None) -> tuple[str, float, float]:
        """Language, its share of the probability by code length, and the margin to the second.

        The margin is the second best size's excess over the best, as a part of the best.
        """
        if not text or not self.by_language or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        best = min(sizes, key=sizes.__getitem__)
        low = sizes[best]
        score = 1 / sum(2.0 ** (-8 * min(s - low, 100)) for s in sizes.values())
        margin = min((s for lang, s in sizes.items() if lang != best), default=2 * low) / low - 1
        return best, score, margin


_COMPRESSORS: dict[int, Compressors] = {}


def identify(raw: dict[str, bytes], text: Column, min_margin: float = 0.0) -> Column:
    """A struct of ``lang``, ``score`` (0 to 1) and ``margin`` for each whole text.

    ``und`` with score 0 is returned for a text that is null or has no letter, and, with the score kept,
    where the margin is below ``min_margin`` and the text has ``MARGIN_BYTES`` or more or the two best sizes
    are equal. Without a ``min_margin`` the commonest language is returned where languages tie.
    """
    key = hash(tuple(raw.items()))

    @F.pandas_udf(RESULT)
    def of(texts: pd.Series) -> pd.DataFrame:
        if key not in _COMPRESSORS:
            _COMPRESSORS.clear()
            _COMPRESSORS[key] = Compressors(raw)
        own = _COMPRESSORS[key]
        rows = [own.identify(t if isinstance(t, str) else None) for t in texts]
        found = pd.DataFrame(rows, columns=["lang", "score", "margin"])
        long = np.array([isinstance(t, str) and len(t.encode()) >= MARGIN_BYTES for t in texts], bool)
        found.loc[(found["margin"] < min_margin) & (long | (found["margin"] == 0)), "lang"] = UNKNOWN
        return found

    return of(text)


def predict(docs: DataFrame, raw: dict[str, bytes], min_margin: float = 0.0) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``margin``, in place of columns of those names.

    Only ``text`` is an input. Every row of repeated ids or texts gets the same answer. Without any
    learned language all rows are ``und``. No rows give no rows.
    """
    name = unused_name(docs, "found")
    found = docs.withColumn(name, identify(raw, F.col("text"), min_margin))
    return found.withColumns(
        {
            "lang_pred": F.col(f"{name}.lang"),
            "score": F.col(f"{name}.score"),
            "margin": F.col(f"{name}.margin"),
        }
    ).drop(name)
