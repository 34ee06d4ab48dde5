"""Language identification by compression.

Each language has a raw-content zstandard dictionary: whole sample texts of
that language, normalised.  A text is cut into blocks short enough that a
dictionary matters in each of them; every block of the whole text is
compressed with every language's dictionary, and the language with the
smallest total wins.  The score is the share of the runner-up's size that
the winner saves; with a narrow margin the text is rejected.  Texts that tie
are compressed once more at a finer level.

The dictionaries are the only thing fitted, on a sample with a documented
bound (``DOCS_PER_LANGUAGE`` texts and three times ``DICTIONARY_BYTES`` for each of
at most ``MAX_LANGUAGES`` languages), so they fit a task's closure at any input
size.  A wrong label in the sample would put one language's text into another's
dictionary, so the sample is halved, each half is judged by dictionaries of the
other, and only texts whose label is confirmed are used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from .common import col, map_arrow

DICTIONARY_BYTES = 110 << 10
DOCS_PER_LANGUAGE = 400
MAX_LANGUAGES = 256
LEVEL = 9
TIE_LEVEL = 12
CONFIRM_MARGIN = 0.02
BLOCK_BYTES = 4 << 10
MIN_MARGIN = 0.004
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalise(text: str | None) -> bytes:
    """Lower-cased letters with single blanks between their runs, and at both ends."""
    letters = _NOT_LETTERS.sub(" ", text or "").strip()
    if not letters.replace(" ", "").isalpha():
        # Number signs such as one half are neither digits nor letters.
        letters = " ".join("".join(c if c.isalpha() else " " for c in letters).split())
    return f" {letters.lower()} ".encode() if letters else b""


@dataclass(frozen=True)
class LanguageModel:
    """The normalised sample of each language, in order of the names."""

    names: tuple[str, ...]
    samples: tuple[bytes, ...]
    level: int = LEVEL
    block_bytes: int = BLOCK_BYTES

    def _packers(self, level: int) -> list:
        packers = []
        for sample in self.samples:
            dictionary = zstandard.ZstdCompressionDict(
                sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=level)
            packers.append(zstandard.ZstdCompressor(
                dict_data=dictionary, level=level, write_content_size=False,
                write_checksum=False, write_dict_id=False).compress)
        return packers

    def scorer(self):
        """A function from a text to ``(language, score)``."""
        packers, finer = self._packers(self.level), []

        def score(text: str | None) -> tuple[str, float]:
            data = normalise(text)
            if not data or not packers:
                return UNKNOWN, 0.0
            blocks = [data[i:i + self.block_bytes] for i in range(0, len(data), self.block_bytes)]
            sizes = [sum(len(pack(b)) for b in blocks) for pack in packers]
            order = sorted(zip(sizes, self.names))
            if len(order) == 1:
                return order[0][1], 1.0
            if order[0][0] == order[1][0]:
                finer[:] = finer or self._packers(TIE_LEVEL)
                order = sorted((n + sum(len(pack(b)) for b in blocks), name)
                               for n, pack, name in zip(sizes, finer, self.names))
            return order[0][1], 1.0 - order[0][0] / order[1][0]

        return score


def _model(texts: dict[str, list[str]], dictionary_bytes: int, level: int,
           block_bytes: int) -> LanguageModel:
    names = tuple(sorted(texts))
    samples = (b"".join(dict.fromkeys(map(normalise, texts[n])))[:dictionary_bytes] for n in names)
    return LanguageModel(names, tuple(x or b" " * 8 for x in samples), level, block_bytes)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE,
        dictionary_bytes: int = DICTIONARY_BYTES, max_languages: int = MAX_LANGUAGES,
        level: int = LEVEL, block_bytes: int = BLOCK_BYTES) -> LanguageModel:
    """Dictionaries from the rows with a language: per language the texts of
    ``docs_per_language`` rows drawn by a hash of the id, as far as they fit
    three times ``dictionary_bytes``; repeats and texts whose label the other
    half does not confirm are left out (all are kept where none is confirmed).
    Null languages and texts without a letter teach nothing; with more than
    ``max_languages`` languages a ValueError is raised."""
    rows = labelled.filter(col(lang_col).isNotNull() & col(text_col).rlike(r"\p{L}"))
    rows = rows.select(col(lang_col).alias("lang"), col(text_col).alias("text"),
                       F.xxhash64(col(id_col), col(text_col)).alias("draw"))
    fits = rows.withColumn("size", F.octet_length("text")).filter(F.col("size") <= dictionary_bytes)
    counts = rows.groupBy("lang").agg(F.count_if(F.octet_length("text") <= dictionary_bytes).alias("n"))
    counts = dict(map(tuple, counts.limit(max_languages + 1).collect()))
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    # Of a language's rows only about twice the sample is ever moved: those whose
    # hash is small enough, however many rows and tasks there are.
    names, share = list(counts), F.lit(1.0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, min(1.0, 2.0 * docs_per_language / max(n, 1))).otherwise(share)
    place = F.pmod(F.col("draw"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    fits = fits.withColumn("place", place).filter(F.col("place") < share)
    drawn = Window.partitionBy("lang").orderBy("place", "draw", "text")
    sample = (fits.withColumn("n", F.row_number().over(drawn))
              .filter(F.col("n") <= docs_per_language))
    # Texts beyond the sample's size stay on the executors.
    sample = (sample.withColumn("until", F.sum("size").over(Window.partitionBy("lang").orderBy("n")))
              .filter(F.col("until") <= 3 * dictionary_bytes))
    texts: dict[str, list[str]] = {n: [] for n in names}
    for lang, text in sample.orderBy("lang", "n").select("lang", "text").toLocalIterator():
        texts[lang].append(text)
    halves = [{n: x[k::2] for n, x in texts.items()} for k in (0, 1)]
    confirmed: dict[str, list[str]] = {n: [] for n in names}
    for half, other in (halves, halves[::-1]):
        judge = _model(other, dictionary_bytes, level, block_bytes).scorer()
        for n, own in half.items():
            for text in own:
                name, score = judge(text)
                if name == n and score >= CONFIRM_MARGIN:
                    confirmed[n].append(text)
    return _model({n: confirmed[n] or texts[n] for n in names}, dictionary_bytes, level, block_bytes)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             columns: list[str] | None = None, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``(row, lang_pred, score, rejected)``: ``row`` holds the ``columns`` of
    ``docs`` (all by default).

    A null text or one without a letter is ``und`` with score 0.  ``rejected``
    holds for ``und`` and for scores under ``min_margin``.  Equal sizes go to the
    language first by name with score 0.  Only ``text_col`` is judged, so
    repeated rows agree.  An empty table gives no rows.
    """
    columns = columns or docs.columns
    rows = docs.select(F.struct(*[col(c) for c in columns]).alias("row"), col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            found = [score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()),
                 pa.array([x for _, x in found], pa.float64())], ["row", "lang_pred", "score"])

    schema = StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double")
    return map_arrow(rows, run, schema).withColumn(
        "rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_margin))


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text",
                    min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is told, all columns as they are."""
    return identify(docs, model, text_col, None, min_margin).filter("NOT rejected").select("row.*")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """True for the rows kept from training: one fold by CRC-32 of the id's text
    (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(col(id_col).cast("string"), F.lit(""))) % folds == 0
