"""Language identification by mixture inference.

Each language is a distribution of character trigrams (letters lower-cased, all
else one blank), hashed to ``GRAMS`` cells.  A document's trigrams are taken as
drawn from a mixture of languages; expectation-maximisation finds the mixture's
proportions, and the set of languages is the one of the largest penalised
likelihood: languages enter by their share in the full mixture while the gain
exceeds half the logarithm of the number of trigrams for each.  Trigrams
overlap, so a third of the log-likelihood counts.  The iteration goes on until
no proportion changes by ``SETTLED``, however small a language's share is.

The distributions are learned from a bounded sample: of each language the
``PER_LANGUAGE`` labelled training rows of the smallest key hash, whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwright.llm.common import bounded_batches, checked_broadcast, rows_of

GRAMS = 1 << 14
PER_LANGUAGE = 2000
#: Change of the proportions below which the mixture has converged.  Each round
#: raises the likelihood, so it does; ROUNDS only ends cycles of rounding errors.
SETTLED, ROUNDS = 1e-4, 10_000
#: Distinct values of ``lang`` that can be learned; more raise, as they are no languages.
MOST_LANGUAGES = 1000
UNKNOWN = "und"
ROWS = 4096

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000))
    return _LETTERS[0]


def held_out(key: Column) -> Column:
    """Whether a key's CRC-32 (of its decimal text) leaves no remainder by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the trigram cells of a text; None if it has no letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[np.minimum(codes, 0xFFFF)]
    if (high := codes > 0xFFFF).any():
        letter = letter.copy()
        letter[high] = [chr(c).isalpha() for c in codes[high].tolist()]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32).astype(np.uint64)
    keep = np.ones(len(codes), bool)
    keep[1:] = letter[1:] | letter[:-1]
    codes = np.concatenate([[np.uint64(32)], codes[keep], [np.uint64(32)]])
    mixed = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:] * np.uint64(0x165667B19E3779F9)
    cells = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(50)
    return np.bincount(cells.astype(np.int64), minlength=GRAMS)


def mixture(counts: np.ndarray, likely: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood by EM; ``likely`` is (grams, languages)."""
    share, weight = start, counts / counts.sum()
    for _ in range(rounds):
        before = share
        share = share * ((weight / (likely @ share)) @ likely)
        if np.abs(share - before).max() < SETTLED:
            break
    return share, float(counts @ np.log(likely @ share))


def infer(counts: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Proportions of the languages (columns of ``model``), zero for those left out."""
    grams = np.flatnonzero(counts)
    n, likely = counts[grams].astype(float), model[grams]
    size = model.shape[1]
    full, _ = mixture(n, likely, np.full(size, 1 / size))
    single = n @ np.log(likely)
    # The first language is the likeliest alone; the others follow by their share.
    order = sorted(range(size), key=lambda i: (i != int(np.argmax(single)), -full[i], i))
    best, value = np.eye(size)[order[0]], single[order[0]] / 3
    for k in range(2, size + 1):
        chosen = order[:k]
        share, fit = mixture(n, likely[:, chosen], np.maximum(full[chosen], 1e-3) / np.maximum(full[chosen], 1e-3).sum())
        new = fit / 3 - (k - 1) * np.log(n.sum()) / 2
        if new <= value:
            break
        value = new
        best = np.zeros(size)
        best[chosen] = share
    return best


def _counted(batches):
    for batch in batches:
        sums: dict[str, np.ndarray] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if (counts := gram_counts(text.as_py())) is not None:
                sums[lang] = sums.get(lang, 0) + counts
        for lang, counts in sums.items():
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cells)), pa.array(cells), pa.array(counts[cells])], names=["lang", "cell", "n"])


def _least_hashed(rows: DataFrame, most: int) -> DataFrame:
    """The distinct doc_id of each language's ``most`` rows of the smallest key hash.

    Cells of the hash are counted first, so that only the rows of the cell in
    which a language's last row lies are ranked, not all of its rows.
    """
    token = F.xxhash64("doc_id")
    marked = rows.select("lang", "doc_id", token.alias("token"), F.shiftrightunsigned(token, 52).alias("cell"))
    counts = marked.groupBy("lang", "cell").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("cell"))
    counts = counts.withColumn("room", F.lit(most) - upto + F.col("n")).filter("room > 0")
    near = marked.join(checked_broadcast(counts), ["lang", "cell"])
    rank = F.row_number().over(Window.partitionBy("lang", "cell").orderBy("token", "doc_id"))
    last = near.filter("n > room").withColumn("rank", rank).filter("rank <= room")
    return near.filter("n <= room").select("doc_id").union(last.select("doc_id")).distinct()


def learn(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and their trigram distributions, smoothed, as (GRAMS, languages).

    Only rows that aren't held out, with a language, are read.  At most
    ``per_language`` keys of each language are used, so the sums that meet on
    the driver are bounded by MOST_LANGUAGES times GRAMS; a table with more
    languages raises.  Of rows that repeat a key, all are read; texts of any
    length are read whole; an empty table gives no languages.
    """
    rows = bounded_batches(documents).select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.filter("lang is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    if (seen := rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).count()) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different values of {lang}: {seen}")
    ids = _least_hashed(rows.select("lang", "doc_id"), per_language)
    sums = rows_of(rows, ids, "doc_id").select("lang", "text").mapInArrow(_counted, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = sums.toPandas()
    names = sorted(set(found["lang"]))
    model = np.full((GRAMS, len(names)), 0.5)
    place = {name: i for i, name in enumerate(names)}
    model[found["cell"].to_numpy(np.int64), found["lang"].map(place).to_numpy(np.int64)] += found["n"].to_numpy(float)
    return names, model / model.sum(axis=0) if names else model


def _predicted(batches, names: list[str], model: np.ndarray):
    for batch in batches:
        texts = batch.column(0)
        others = batch.columns[1:]
        for start in range(0, len(texts), ROWS):
            pred, score, mix = [], [], []
            for text in texts.slice(start, ROWS):
                counts = gram_counts(text.as_py()) if names else None
                if counts is None:
                    pred.append(UNKNOWN), score.append(0.0), mix.append("")
                    continue
                share = infer(counts, model)
                best = int(np.argmax(share))
                pred.append(names[best])
                score.append(min(1.0, float(share[best])))
                mix.append(",".join(f"{names[i]}:{share[i]:.3f}" for i in np.argsort(-share, kind="stable") if share[i] > 0))
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(start, ROWS) for c in others), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(mix, pa.string())],
                names=[*batch.schema.names[1:], "lang_pred", "score", "languages"],
            )


def predict(documents: DataFrame, names: list[str], model: np.ndarray, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id (and text), lang_pred, score, languages of each row, from the text alone.

    ``score`` is the share of the language that has most of the text, and
    ``languages`` the whole mixture.  A text that is null or without a letter
    is ``und`` with score 0, and so is any text if no language was learned.
    Rows stand for themselves, whatever their keys; ties go to the first
    language by name; long texts are read whole; other columns are ignored.
    """
    rows = bounded_batches(documents).select(F.col(f"`{text}`").alias("__text"), F.col(f"`{key}`").cast("long").alias("doc_id"), *([F.col(f"`{text}`").alias("text")] if keep_text else []))
    kept = "doc_id long, " + ("text string, " if keep_text else "")
    return rows.mapInArrow(lambda batches: _predicted(batches, names, model), kept + "lang_pred string, score double, languages string")


def accepted(documents: DataFrame, least: float = 0.3, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows whose main language has ``least`` of the text or more, all columns.

    Learns from the rows themselves.  Texts without a letter are rejected; rows
    stand for themselves, and columns may have any names.
    """
    learned, model = learn(documents, key, text, lang)
    names, inner = documents.columns, [f"c{i}" for i in range(len(documents.columns))]
    body, rows = inner[names.index(text)], bounded_batches(documents).toDF(*inner)

    def chosen(batches):
        for batch in batches:
            found = pa.Table.from_batches(_predicted([batch.select([body])], learned, model))
            mask = np.array(found["score"].to_pylist()) >= least if batch.num_rows else []
            yield batch.filter(pa.array(mask, pa.bool_()))

    return rows.mapInArrow(chosen, rows.schema).toDF(*names)
