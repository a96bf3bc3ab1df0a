"""Quality by what a public vocabulary makes of a text, next to plain counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.llm.common import table
from graticule.llm.word_ids import vocabulary_path
from graticule.session import materialize

SYMBOLS = "#*$%&|<>"  # fixed by the definition of n_symbols
WINDOW = 8  # words
BLANK = " \t\n\v\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("chars_per_token", "byte_share", "entropy")
PEERS = 50  # texts a band is taken from at least
# Where a band comes from, the first with enough texts: the language's class, it and its neighbour classes, the whole
# language; entropy follows length more than language; at last all texts.
WIDER = {
    "chars_per_token": ("class", "near", "key", "any"),
    "byte_share": ("class", "near", "key", "any"),
    "entropy": ("class", "any_class", "any_near", "any"),
}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words within windows that occur twice or more, by exact numbers of longer and longer runs."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    length = 1
    while length < window:
        # runs of twice the length are pairs of runs; equal pairs get equal numbers
        pairs = codes[:-length] * (codes.max() + 1) + codes[length:]
        distinct, codes = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        length *= 2
    found = np.bincount(codes)[codes] > 1
    marks = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(found)
    marks[starts] += 1
    np.add.at(marks, starts + window, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    text, words = raw.decode("utf-8", "replace"), raw.split()
    chars = len(text) - (len(raw) - sum(map(len, words)))
    lines, repeats = set(), 0
    for line in text.split("\n"):
        if line.strip(BLANK):
            repeats += line in lines
            lines.add(line)
    return len(words), chars, sum(map(text.count, SYMBOLS)), repeats, repeated_words(words)


_MODELS: dict = {}


def _model(path: str | None):
    """The vocabulary of this worker process, loaded once, and which ids stand for single bytes."""
    path = vocabulary_path(path, "piece_bpe_32k.model")
    if path not in _MODELS:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        _MODELS[path] = model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    return _MODELS[path]


def token_measures(ids: np.ndarray, chars: int, is_byte: np.ndarray) -> tuple[int, float | None, float | None, float | None]:
    """Tokens, characters of words per token, share of byte tokens, entropy of the tokens in bits."""
    if not len(ids):
        return 0, None, None, None
    _, n = np.unique(ids, return_counts=True)
    p = n / len(ids)
    return len(ids), chars / len(ids), float(is_byte[ids].mean()), float(-(p * np.log2(p)).sum())


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", vocabulary: str | None = None) -> DataFrame:
    """One row per input row: doc_id, lang, the plain counts, n_tokens and the three measures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, is_byte = _model(vocabulary)
        for given in batches:
            for at in range(0, given.num_rows, 256):
                part = given.slice(at, 256)
                raws = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in part.column(2)]
                plain = [counts(r) for r in raws]
                tokens = model.encode([r.decode("utf-8", "replace") for r in raws], num_threads=1)
                made = [token_measures(np.array(t, dtype=np.int64), c[1], is_byte) for t, c in zip(tokens, plain)]
                ints = [pa.array(c, pa.int64()) for c in zip(*plain)]
                n, *rest = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], *ints, pa.array(n, pa.int64()), *[pa.array(r, pa.float64()) for r in rest]],
                    names=["doc_id", "lang", *COUNTS, "n_tokens", *MEASURES],
                )

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("binary").alias("text"))
    longs = ", ".join(f"{c} long" for c in (*COUNTS, "n_tokens"))
    doubles = ", ".join(f"{c} double" for c in MEASURES)
    return picked.mapInArrow(run, f"doc_id long, lang string, {longs}, {doubles}")


def bands(sound: DataFrame, width: float) -> DataFrame:
    """Per language (``_key``) and length class the band [low, high] of each measure.

    The median less and plus ``width`` robust deviations: its distances to the quartiles
    over 0.6745, either side its own, as the measures are skewed. A class of fewer than
    ``PEERS`` texts takes its band from more of them, see ``WIDER``.
    """
    keys = {"class": ("_key", "_class"), "near": ("_key", "_near"), "key": ("_key", None), "any_class": (None, "_class"), "any_near": (None, "_near"), "any": (None, None)}
    nothing = {"_key": F.lit(None).cast("string"), "_class": F.lit(None).cast("long")}

    def peers(level: str, key: str | None, length: str | None, step: int = 0):
        return F.struct(
            F.lit(level).alias("level"), (F.col(key) if key else nothing["_key"]).alias("key"), (F.col("_class") + step if length else nothing["_class"]).alias("class")
        )

    asked = [peers(level, *by, step) for level, by in keys.items() for step in ((-1, 0, 1) if by[1] == "_near" else (0,))]
    quartiles = [F.percentile_approx(m, [0.25, 0.5, 0.75], 1000).alias(m) for m in MEASURES]
    dealt = sound.select(*MEASURES, F.explode(F.array(*asked)).alias("_"))
    found = materialize(dealt.groupBy("_.level", "_.key", "_.class").agg(F.count(F.lit(1)).alias("n"), *quartiles), "bands")
    cells = found.where("level = 'class'").select(F.col("key").alias("_key"), F.col("class").alias("_class"), F.struct("n", *MEASURES).alias("class"), F.lit(0).alias("_all"))
    for level, (key, length) in list(keys.items())[1:]:
        held = found.where(F.col("level") == level).select(F.col("key").alias("_key"), F.col("class").alias("_class"), F.struct("n", *MEASURES).alias(level), F.lit(0).alias("_all"))
        by = [c for c, used in (("_key", key), ("_class", length)) if used] or ["_all"]
        cells = cells.join(held.select(*by, level), by)
    for m in MEASURES:
        *levels, last = WIDER[m]
        quartile = F.coalesce(*[F.when(F.col(v)["n"] >= PEERS, F.col(v)[m]) for v in levels], F.col(last)[m])
        low, middle, high = (F.get(quartile, F.lit(k)) for k in range(3))
        least = F.lit(0.02) if m == "byte_share" else middle * 0.02
        cells = cells.withColumn(f"_low_{m}", middle - F.greatest((middle - low) * width / 0.6745, least))
        cells = cells.withColumn(f"_high_{m}", middle + F.greatest((high - middle) * width / 0.6745, least))
    return cells.select("_key", "_class", *[f"_{side}_{m}" for m in MEASURES for side in ("low", "high")])


def fertility(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", vocabulary: str | None = None, width: float = 3.5
) -> DataFrame:
    """One row per input row: doc_id, lang, counts, n_tokens, measures, base_failed, kept.

    A text fails the base rule with fewer than 20 words, or when over 30 % of its words
    lie in repeated windows of 8. Otherwise it is kept if each measure lies in its band:
    the median of the texts of its language and length class (2**k to 2**(k+1) tokens)
    that pass the base rule, less and plus ``width`` robust deviations, see ``bands``.

    A null text has no words; a null language is a language of its own; a null doc_id stays
    null; repeated rows are judged alike; an empty table gives no rows; other columns are
    not read. Whole texts are read once; bands need one row per language and class.
    """
    measured = materialize(measure(docs, doc_id, text, lang, vocabulary), "fertility")
    return judged(measured, width)


def judged(measured: DataFrame, width: float = 3.5) -> DataFrame:
    """The rows of ``measure`` with base_failed and kept."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    key = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    measured = measured.select("*", failed.alias("base_failed"), key.alias("_key"), F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).alias("_class"))
    joined = measured.join(bands(measured.where("NOT base_failed"), width), ["_key", "_class"], "left")
    inside = F.lit(True)
    for m in MEASURES:
        inside = inside & F.col(m).between(F.col(f"_low_{m}") - 1e-9, F.col(f"_high_{m}") + 1e-9)
    return joined.select("doc_id", "lang", *COUNTS, "n_tokens", *MEASURES, "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"))


def query(spark, sf_dir):
    """All documents judged by the base rule and the bands."""
    judged = fertility(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "chars_per_token", "byte_share", "entropy")
