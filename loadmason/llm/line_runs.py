"""Deleting repeated runs of lines, by prefix doubling over the sequences of line ids.

Every document is a sequence of its lines with a word; blank lines belong to
no run. The rank of a position for a length of 2^k is the earliest position
whose next 2^k lines are the same, so equal ranks are equal runs, and ranks
for 2^(k+1) lines come from pairs of ranks. Positions whose run of 2^k lines
comes up once only drop out at each step: no longer run from there repeats.

A run of any length m is told by two overlapping ranks. Positions with equal
ranks of that kind are the interval of the suffix array whose common prefix
has at least m lines; the smallest of them is the first copy, and the lines of
all others are deleted. A run must hold ``min_words`` words. It is enough to
look at the shortest such runs that start or that end at each line: every
maximal repeated run is made up of them. As every line has a word, no run looked
at is longer than ``min_words`` lines, and that bounds the rounds.

Documents are ordered by ``doc_id`` (null last), then by a hash of their text.
Rows with the same id and text are one document, which does not repeat itself;
all of them stay and lose the same lines. A null text has no lines and stays
null; a text whose lines are all deleted is empty. Other columns stay as they
are, but ``n_chars``, where there is one, is counted anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import park, quoted
from .shared_keys import KeyFilter, free_names

MIN_WORDS = 5
WORD = r"[^\x20\x09-\x0D]+"
_DOC = ["d", "t"]


def _order() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))


def lines_of(docs: DataFrame) -> DataFrame:
    """The lines with a word: their document (``d``, ``t``), ``line`` among these, ``at`` among all, ``words`` and ``content``, a digest."""
    numbered = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    split = docs.select(_order().alias("d"), F.xxhash64("text").alias("t"), F.filter(numbered, lambda x: x["line"].rlike(WORD)).alias("lines"))
    found = split.select("d", "t", F.posexplode("lines").alias("line", "found"))
    return found.select(
        "d", "t", "line", F.col("found.at").alias("at"),
        F.regexp_count("found.line", F.lit(WORD)).alias("words"),
        F.unhex(F.md5("found.line")).alias("content"),
    )


def _position(line: str = "line") -> Column:
    return F.struct(F.col("d"), F.col("t"), F.col(line).alias("line"))


def _repeated(positions: DataFrame, keys: list[str]) -> DataFrame:
    """The positions whose key comes up at another position too, with the earliest one as ``rank``.

    The keys are written out first, so that the join has plain shuffles on
    both sides, of which Spark can split the part of a very common line.
    """
    grouped = positions.groupBy(*keys).agg(F.min(_position()).alias("rank"), F.max(_position()).alias("last"))
    several = park(grouped.where("rank != last").select(*[F.col(k).alias(f"__{k}") for k in keys], "rank"), "several")
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys])
    return positions.join(several, on)


def double(ranks: DataFrame, length: int) -> DataFrame:
    """Ranks for twice the length, from ranks for ``length``."""
    after = ranks.select("d", "t", (F.col("line") - length).alias("line"), F.col("rank").alias("next"))
    pairs = ranks.select("d", "t", "line", F.col("rank").alias("own")).join(after, [*_DOC, "line"])
    return _repeated(pairs, ["own", "next"]).select("d", "t", "line", "rank")


def shortest_runs(repeated: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs of repeated lines with enough words from each line on, and up to each line: ``line`` and ``length``."""
    by_line = Window.partitionBy(*_DOC).orderBy("line")
    ahead, back = F.lit(None).cast("int"), F.lit(None).cast("int")
    # from the longest to the shortest, so that the shortest stays
    for more in range(min_words - 1, -1, -1):
        for move, sign in ((F.lead, 1), (F.lag, -1)):
            if more:
                words = reduce(lambda a, b: a + b, [move("words", k).over(by_line) for k in range(1, more + 1)], F.col("words"))
                whole = (move("line", more).over(by_line) == F.col("line") + sign * more) & (words >= min_words)
            else:
                whole = F.col("words") >= min_words
            if sign > 0:
                ahead = F.when(whole, more + 1).otherwise(ahead)
            else:
                back = F.when(whole, more + 1).otherwise(back)
    found = repeated.select("d", "t", "line", ahead.alias("ahead"), back.alias("back"))
    starts = found.select("d", "t", "line", F.col("ahead").alias("length"))
    ends = found.where("back > 1").select("d", "t", (F.col("line") - F.col("back") + 1).cast("int").alias("line"), F.col("back").alias("length"))
    return starts.unionByName(ends).where("length IS NOT NULL").distinct()


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The lines to delete: ``d``, ``t`` and ``at``."""
    if min_words < 1:
        raise ValueError("a run has at least one word")
    lines = park(lines_of(docs), "lines")
    repeated = park(_repeated(lines.select("d", "t", "line", "at", "words", "content"), ["content"]).drop("content", "__content"), "repeated")
    runs = park(shortest_runs(repeated.select("d", "t", "line", "words").distinct(), min_words), "runs")
    ranks, length, gone = repeated.select("d", "t", "line", "rank").distinct(), 1, []
    while length <= min_words:
        if length > 1:
            ranks = park(double(ranks, length // 2), "ranks")
        of_length = runs.where((F.col("length") >= length) & (F.col("length") < 2 * length))
        gone.append(_copies(of_length, ranks, length))
        length *= 2
    copied = reduce(DataFrame.unionByName, gone).distinct()
    return repeated.select("d", "t", "line", "at").distinct().join(copied, [*_DOC, "line"]).select("d", "t", "at")


def _copies(runs: DataFrame, ranks: DataFrame, length: int) -> DataFrame:
    """The lines of runs that come up earlier too; the runs have ``length`` lines or up to twice as many."""
    first = ranks.select("d", "t", "line", F.col("rank").alias("first"))
    held = runs.join(first, [*_DOC, "line"])
    if length == 1:
        return held.where(F.col("first") != _position()).select("d", "t", "line")
    second = ranks.select("d", "t", F.col("line").alias("tail"), F.col("rank").alias("second"))
    held = held.withColumn("tail", F.col("line") + F.col("length") - length).join(second, [*_DOC, "tail"])
    found = _repeated(held, ["length", "first", "second"]).where(F.col("rank") != _position())
    return found.select("d", "t", F.explode(F.sequence(F.col("line"), F.col("line") + F.col("length") - 1)).alias("line"))


def delete_copies(docs: DataFrame, min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """The documents without the later copies of repeated runs of lines.

    With ``counts`` also ``n_lines`` (with a word), ``n_deleted`` and
    ``longest_run``, the most deleted lines in a row, blank ones aside.
    """
    order, hashed, at, kept_text, worded = free_names(docs, "order_of", "text_of", "gone_of", "kept_of", "worded_of")
    gone = later_copies(docs, min_words).groupBy(*_DOC).agg(F.collect_set("at").alias(at))
    gone = park(gone.withColumnsRenamed({"d": f"{order}r", "t": f"{hashed}r"}), "gone-lines")
    keyed = docs.withColumns({order: _order(), hashed: F.xxhash64("text")})
    # only texts that may lose lines are shuffled, all others stay where they are
    some, rest = KeyFilter(gone.select(f"{hashed}r"), "shortened").split(keyed, F.col(hashed))
    same = (F.col(order) == F.col(f"{order}r")) & (F.col(hashed) == F.col(f"{hashed}r"))
    met = some.join(gone.hint("shuffle_hash"), same, "left").drop(f"{order}r", f"{hashed}r")
    joined = met.unionByName(rest.withColumn(at, F.lit(None).cast(gone.schema[at].dataType)))
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), at)
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    whole = F.col(at).isNull()
    steps = {kept_text: F.when(whole, F.col("text")).otherwise(text)}
    if counts:
        numbered = F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(WORD), i)), lambda i: i.isNotNull())
        steps[worded] = F.coalesce(numbered, F.array())
    # a layer for each step: an expression with a function in it is not written out twice
    joined = joined.withColumns(steps)
    columns = {c: F.col(kept_text) if c == "text" else F.col(quoted(c)) for c in docs.columns}
    if "n_chars" in columns:
        columns["n_chars"] = F.length(kept_text).cast(docs.schema["n_chars"].dataType)
    if counts:
        columns["n_lines"] = F.size(worded).cast("long")
        columns["n_deleted"] = F.when(whole, 0).otherwise(F.size(at)).cast("long")
        marks = F.transform(worded, lambda i: F.when(F.array_contains(at, i), "x").otherwise("o"))
        longest = F.array_max(F.transform(F.split(F.array_join(marks, ""), "o+"), lambda run: F.length(run)))
        columns["longest_run"] = F.when(whole, 0).otherwise(longest).cast("long")
    return joined.select(*[c.alias(name) for name, c in columns.items()])
