"""Quality rules kept as a ledger: every rule is evaluated once, its failures stored as bits.

``ledger`` measures each text and evaluates all rules, giving the measurements
and one number whose bits say which rules failed. A policy is a set of rules,
that is, a mask: a document is kept if no bit of the mask is set. Changing a
policy, or asking what each of its rules does, never reads the texts again.

A null text has no words, no lines with a word and no symbols; it fails the
rules an empty text fails. Rows that share an id stay apart; other columns of
the documents are not read. An empty table has an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices
from .text_arrays import SPACE, TextArrays, byte_table, duplicate_lines, repeated_words

SYMBOLS = byte_table(b"#*$%&|<>")
REPEAT_WORDS = 5
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# Bit by bit: the rule's name, and when a document fails it. Bits are never reused.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("many_words", "n_words > 1000000"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
)

# Versions of the policy. A published version never changes.
POLICIES = {
    1: ("few_words", "repeated_words"),
    2: ("few_words", "repeated_words", "many_words", "short_words", "long_words", "symbols", "repeated_lines"),
}
BASE, CURRENT = 1, 2


def mask(version: int) -> int:
    bits = {name: 1 << bit for bit, (name, _) in enumerate(RULES)}
    return sum(bits[name] for name in POLICIES[version])


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of each whole text."""
    continuation = np.zeros(256, bool)
    continuation[0x80:0xC0] = True
    characters = ~SPACE & ~continuation

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            arrays = TextArrays(texts)
            lines, repeats = duplicate_lines(arrays)
            found = [
                arrays.n_words, arrays.count_bytes(characters), arrays.count_bytes(SYMBOLS),
                lines, repeats, repeated_words(arrays, REPEAT_WORDS),
            ]
            columns = [batch.column("doc_id"), *[pa.array(a, pa.int64()) for a in found]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *MEASUREMENTS])

    schema = ", ".join(f"{c} long" for c in ("doc_id", *MEASUREMENTS))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements of each document, and ``failed``, the bits of the rules it fails."""
    bits = [F.when(F.expr(test), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, (_, test) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs).withColumn("failed", failed.cast("long"))


def apply_policy(entries: DataFrame, version: int = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a version of the policy."""
    fails = lambda v: F.col("failed").bitwiseAND(F.lit(mask(v))) != 0
    return entries.withColumn("base_failed", fails(BASE)).withColumn("kept", ~fails(BASE) & ~fails(version))


def ablations(entries: DataFrame, version: int = CURRENT) -> DataFrame:
    """For each rule of a policy: the documents that fail it, that only it rejects, and that the policy rejects.

    Documents are counted by their bits first, so what is shuffled is at most
    a row for each set of failed rules and task.
    """
    held = mask(version)
    counts = entries.groupBy(F.col("failed").bitwiseAND(F.lit(held)).alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    rules = [
        F.struct(F.lit(name).alias("rule"), F.lit(1 << bit).cast("long").alias("bit"))
        for bit, (name, _) in enumerate(RULES)
        if held >> bit & 1
    ]
    spread = counts.select("failed", "n", F.inline(F.array(*rules)))
    count_if = lambda test: F.sum(F.when(test, F.col("n")).otherwise(F.lit(0))).alias
    return spread.groupBy("rule").agg(
        count_if(F.col("failed").bitwiseAND(F.col("bit")) != 0)("n_failed"),
        count_if(F.col("failed") == F.col("bit"))("n_only"),
        count_if(F.col("failed") != 0)("n_rejected"),
    )
