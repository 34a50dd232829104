"""Periodic runs of words by seed and extend on diagonals of equal lag."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import chunks, held, pick, words

#: A run has at least so many words, and so many times its period.
LEAST_WORDS = 6
LEAST_TIMES = 4

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _numbers(texts: list[list[bytes]]) -> np.ndarray:
    """A number for each word of all texts in a row: equal for equal words of one text, never for those of two."""
    found = pa.array([word for text in texts for word in text], pa.binary()).dictionary_encode()
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), [len(text) for text in texts])
    return owner * max(1, len(found.dictionary)) + found.indices.to_numpy()


def _repeated(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The places whose key occurs more than once and the number of their key; each place with another of its key after it, and the next of these."""
    order = np.argsort(keys, kind="stable")
    keys, ordered = keys[order], places[order]
    again = keys[1:] == keys[:-1]
    stay = np.append(again, False)[: len(keys)] | np.append(False, again)[: len(keys)]
    names = np.cumsum(np.append(True, ~again)[: len(keys)])[stay]
    back = np.argsort(ordered[stay])
    return ordered[stay][back], names[back], ordered[:-1][again], ordered[1:][again]


def _extent(numbers: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from `at` on, in the direction of step, equal the word `lag` further."""
    most = len(numbers) - lag - at if step > 0 else at + 1
    done, width = 0, 64
    while done < most:
        n = min(width, most - done)
        a = at + done if step > 0 else at - done - n + 1
        unequal = numbers[a : a + n] != numbers[a + lag : a + lag + n]
        if unequal.any():
            return done + int(unequal.argmax() if step > 0 else unequal[::-1].argmax())
        done, width = done + n, 2 * width
    return done


def _overlap(low: int, high: int, least: int, times: int) -> int:
    """Words in which the two copies overlap at least, for a period from `low` on; classes go on from low and high."""
    most = (times - 1) * low
    return most if most >= least - high else min(least - high, _overlap(high + 1, 2 * high, least, times))


def find_runs(numbers: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """All runs (start, length, smallest period) of at least `least` words and `times` periods (3 or more).

    Lags are looked at in classes from 2^j + 1 to 2^(j+1). Two copies of a run of period q that lie q words
    apart overlap in at least max(least - q, (times - 1) * q) words, so each k-gram of the class's
    least overlap that starts in the first copy occurs again q words on. As k is not below q, it cannot
    occur in between (q would not be the smallest period), so the next occurrence in the document is
    the seed, and a k-gram that occurs once needs no longer ones. Seeds of a lag are taken in order of their
    place; one that lies before the end of what this lag has covered is passed over, any other is extended
    both ways word by word.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods are not found by next occurrences")
    found: list[tuple[int, int, int]] = []
    places, names, first, then = _repeated(numbers, np.arange(len(numbers)))
    k, low, high = 1, 1, 1
    while len(places):
        wanted = _overlap(low, high, least, times)
        while k < wanted:
            step = min(k, wanted - k)
            at = np.full(len(numbers) + step, -1, np.int64)
            at[places] = names
            other = at[places + step]
            inside = other >= 0
            keys = names[inside] * (int(names.max(initial=0)) + 1) + other[inside]
            places, names, first, then = _repeated(keys, places[inside])
            k += step
        seeds = (then - first >= low) & (then - first <= high)
        found += _extended(numbers, first[seeds], (then - first)[seeds], k, least, times)
        low, high = high + 1, 2 * high
    return found


def _extended(numbers: np.ndarray, places: np.ndarray, lags: np.ndarray, k: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    first = np.ones(len(places), bool)
    first[1:] = (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)
    covered: dict[int, int] = {}
    for at, lag in zip(places[first].tolist(), lags[first].tolist()):  # seeds next to each other lie on one stretch
        if at < covered.get(lag, 0):
            continue
        end = at + k + _extent(numbers, at + k, lag, 1)
        start = at - (_extent(numbers, at - 1, lag, -1) if at else 0)
        covered[lag] = end
        if end + lag - start >= max(least, times * lag):
            yield start, end + lag - start, lag


def _runs(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in (part for whole in batches for part in chunks(whole)):
            texts = [(text or b"").split() for text in batch.column("text").cast(pa.binary()).to_pylist()]
            numbers = _numbers(texts)
            bounds = np.cumsum([0, *map(len, texts)])
            table = np.array(sorted((s, q, n) for s, n, q in find_runs(numbers, least, times)), np.int64).reshape(-1, 3)
            start, period, length = table.T
            owner = np.searchsorted(bounds, start, "right") - 1
            edges = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(edges, start + period, 1)
            np.add.at(edges, start + length, -1)
            stays = np.cumsum(edges)[:-1] == 0
            collapsed = [b" ".join(text) for text in texts]
            for i in np.unique(owner).tolist():
                collapsed[i] = b" ".join(compress(texts[i], stays[bounds[i] : bounds[i + 1]].tolist()))
            spans = pa.StructArray.from_arrays([pa.array(x) for x in (start - bounds[owner], length, period)], ["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32()), spans)
            columns = [batch.column("doc_id"), pa.array(list(map(len, texts)), pa.int64()), runs, pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.record_batch(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """One row per row of docs: doc_id, n_words, runs (start, length, period by start, then period), collapsed.

    A run is a stretch of consecutive words with smallest period q and at least max(least, times * q)
    words that no neighbour extends; runs may overlap. collapsed is the text of the words that no run holds after
    its first q words, joined by one space. Whole texts are searched; a null text, and one without words, has
    no runs and an empty collapsed text. Rows that repeat an id come back each for itself; null ids stay null.
    An empty table gives no rows; other columns are ignored.
    """
    docs = pick(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_runs(least, times), f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which the ids choose some documents whose words repeat from a place on.

    With h the crc32 of the id in decimal digits and g = floor(h / 10), the n words of a document with h % 10 = 0 go
    on from a = g % n in copies of the p = 1 + floor((n - a) / (3 + g % 8)) words there.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = pick(docs, "doc_id", "text").withColumn("g", F.when(h % 10 == 0, F.floor(h / 10)))
    rows = rows.withColumn("w", F.when(F.col("g").isNotNull(), words(F.col("text"))))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", (F.col("g") % F.nullif("n", F.lit(0))).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.col("n") - F.col("a")

    def cut(length: Column) -> Column:
        return F.slice("w", F.col("a") + 1, length)

    copies = F.flatten(F.array_repeat(cut(F.col("p")), F.floor(tail / F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), copies, cut(tail % F.col("p"))), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs(with_planted_periods(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
