"""Line dedup by winnowing: repeated runs of lines go, but for their first place.

A run is a sequence of neighbouring lines with at least MIN_WORDS words; blank lines are not counted and stay.
A line is deleted if it lies in a run that also stands at an earlier place, in the order of (doc_id, line). So
each line's first place stays, and no text is lost from the corpus.

The windows of a document are the shortest runs that begin at a line and those that end at a line. Each
window's fingerprint is its least line hash, and any repeated run contains a window, so two copies of a run
select the same line: a fingerprint that stands at one place only can be skipped with all its windows. The
windows of the others are compared by a digest of their lines; one that stands earlier as well is a match.
The windows around it that match as well extend it both ways: together, matching windows cover exactly the
repeated runs, since each line of a run is in the window that begins at the run's first line or in the
window that ends at the line itself.

No pairs of places are made. Fingerprints and digests are grouped by their first place (combined before the
shuffle, so one line in a third of all documents costs a row per task), and places join that one row.

Nulls and edge cases: a null text stays null, an empty one empty; a text whose lines all go is empty. A null
doc_id comes before others. Repeated rows (equal doc_id and text) are one document, stay repeated, and are treated
alike; very long texts are compared whole; rows of one doc_id with different texts are different documents. Lines repeated within a document go as
well. An empty table gives an empty one. Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import WORD, discard, let, own_names, working_table

#: Words a run has at least.
MIN_WORDS = 50


def _shortest(words: Column, least: int) -> Column:
    """How many of the first elements reach the least sum; null if all don't. Words are 1 at least."""
    none = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
    return F.aggregate(
        words,
        none,
        lambda a, w: F.when(a["sum"] >= least, a).otherwise(F.struct((a["sum"] + w).alias("sum"), (a["n"] + 1).alias("n"))),
        lambda a: F.when(a["sum"] >= least, a["n"]),
    )


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, version (a hash of the text) and the windows: first and last line, digest, fingerprint and its line."""
    lines = F.filter(
        F.transform(
            F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1),
            lambda line: F.struct(
                F.regexp_count(line, F.lit(WORD)).alias("words"), F.xxhash64(line).alias("hash"), F.md5(line).alias("digest")
            ),
        ),
        lambda x: x["words"] > 0,
    )
    # a line has a word, so a shortest run has no more lines than words
    reach = F.lit(min_words)

    def spans(x: Column) -> Column:
        at = F.when(x["n"] > 0, F.sequence(F.lit(1), x["n"])).otherwise(F.array().cast("array<int>"))
        def long_line(i: Column) -> Column:  # the usual case: a line that is a run by itself
            return F.when(F.element_at(x["words"], i) >= min_words, i)

        forward = F.transform(
            at,
            lambda i: F.struct(
                i.alias("first"),
                long_line(i).otherwise(i - 1 + _shortest(F.slice(x["words"], i, reach), min_words)).alias("last"),
            ),
        )
        backward = F.transform(
            at,
            lambda i: F.struct(
                long_line(i).otherwise(i + 1 - _shortest(F.slice(x["back"], x["n"] - i + 1, reach), min_words)).alias("first"),
                i.alias("last"),
            ),
        )
        both = F.array_distinct(F.concat(forward, backward))
        return F.filter(both, lambda s: s["first"].isNotNull() & s["last"].isNotNull())

    def window(x: Column, s: Column) -> Column:
        length = s["last"] - s["first"] + 1
        own = F.slice(x["hashes"], s["first"], length)
        digest = F.unhex(F.md5(F.array_join(F.slice(x["digests"], s["first"], length), "")))
        return let(
            F.array_min(own),
            lambda least: F.struct(
                s["first"].alias("first"),
                s["last"].alias("last"),
                digest.alias("digest"),
                least.alias("fingerprint"),
                (s["first"] - 1 + F.array_position(own, least)).cast("int").alias("line"),
            ),
        )

    def all_windows(found: Column) -> Column:
        columns = F.struct(
            found["words"].alias("words"),
            F.reverse(found["words"]).alias("back"),
            found["hash"].alias("hashes"),
            found["digest"].alias("digests"),
            F.size(found).alias("n"),
        )
        return let(columns, lambda x: F.transform(spans(x), lambda s: window(x, s)))

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("version"),
        let(lines, all_windows).alias("windows"),
    )


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, version and spans (array of first and last line among the lines with words) to delete, a working table."""
    placed = working_table(windows(docs, min_words), "line-windows")
    marks = placed.select("doc_id", "version", F.explode(F.array_distinct(F.transform(
        "windows", lambda w: F.struct(w["fingerprint"].alias("fingerprint"), w["line"].alias("line"))
    ))).alias("mark"))
    place = F.struct("doc_id", "version", "mark.line")
    shared = (
        marks.groupBy(F.col("mark.fingerprint").alias("print"))
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") < F.col("last"))
        .select("print")
    )
    spread = placed.select("doc_id", "version", F.inline("windows")).select(
        "doc_id", "version", "first", "last", "digest", "fingerprint"
    )
    candidates = working_table(
        spread.join(shared, F.col("fingerprint") == F.col("print"), "left_semi").drop("fingerprint"), "line-candidates"
    )
    at = F.struct("doc_id", "version", F.col("first").alias("line"))
    earliest = (
        candidates.groupBy(F.col("digest").alias("matched"))
        .agg(F.min(at).alias("origin"), F.max(at).alias("latest"))
        .where(F.col("origin") < F.col("latest"))
        .select("matched", "origin")
    )
    later = candidates.join(earliest, F.col("digest") == F.col("matched")).where(at > F.col("origin"))
    found = later.groupBy("doc_id", "version").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    out = working_table(found, "line-deletions")
    discard(placed, candidates)
    return out


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, counts: bool = True) -> DataFrame:
    """docs without later repeated runs; with counts, two more columns, n_lines and n_deleted.

    If docs has columns of these names, the new ones take their place; without counts its own stay.
    """
    kept = docs.drop("n_lines", "n_deleted") if counts else docs
    return own_names(kept, ("doc_id", "text"), lambda plain: _dedup(plain, min_words, counts))


def _dedup(docs: DataFrame, min_words: int, counts: bool) -> DataFrame:
    found = deletions(docs, min_words).select(
        F.col("doc_id").alias("__id"), F.col("version").alias("__version"), F.col("spans").alias("__spans")
    )
    keyed = docs.select(*docs.columns, F.col("doc_id").cast("long").alias("__doc"), F.xxhash64("text").alias("__text_hash"))
    # always shuffled: a broadcast where the deletions happen to be few would only hide what a larger corpus needs
    joined = keyed.join(
        found.hint("merge"), F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__version")), "left"
    )

    def rest(lines: Column) -> Column:
        full = F.filter(F.transform(lines, lambda line, i: F.when(line.rlike(WORD), i)), lambda i: i.isNotNull())
        places = let(full, lambda f: F.transform(F.col("__gone"), lambda k: F.element_at(f, k)))
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
        return F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n")

    gone = F.array_distinct(F.flatten(F.transform("__spans", lambda s: F.sequence(s["first"], s["last"]))))
    marked = joined.withColumn("__gone", gone)
    n_lines = F.size(F.split("text", "\n", -1))
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(let(F.split("text", "\n", -1), rest))
    out = [text.alias(c) if c == "text" else F.col(c) for c in docs.columns]
    if not counts:
        return marked.select(*out)
    return marked.select(
        *out,
        F.coalesce(F.when(F.col("text").isNotNull(), n_lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("__spans").isNotNull(), F.size("__gone")), F.lit(0)).cast("long").alias("n_deleted"),
    )
